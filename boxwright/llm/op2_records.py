"""Token ids as length-delimited binary records with masked checksums, and an offset index for shuffled reads.

A record: payload length (u64), masked CRC of those 8 bytes (u32), payload, masked CRC of the payload (u32), all
little-endian. The mask is rotation right by 15 bits plus 0xA282EAD8, the CRC is CRC-32C (see _crc32c), so common record
readers accept the files. A payload: flag (u8, 1: the document has an id), doc_id (i64), bytes per token id (u8), token ids. Beside
``part-N.rec``, ``part-N.idx`` has doc_id, first byte, first token and number of tokens of each record as i64 rows.

Defined results: null or empty text has the end id alone; rows with equal doc_id are ordered by text, nulls first; a
null doc_id sorts first; a very long text is one record; an empty table writes no file and reads back no row; further
columns are not looked at. Every attempt of a task writes files of its own name, and the manifest names those of the
attempts that Spark took: nothing is renamed, so a retried or doubled task needs no special store.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._crc32c import crc32c
from boxwright.llm._shared import documents, shared_dir
from boxwright.llm._text import chunks, utf8
from boxwright.llm._tokens import encoder

HEAD = struct.Struct("<QI")
LONGEST = 1 << 20
META = struct.Struct("<BqB")
MANIFEST = "part int, rec string, docs long, tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(0xA282EAD8)).astype("<u4")


def frames(payloads: list[bytes]) -> list[bytes]:
    sizes = [struct.pack("<Q", len(p)) for p in payloads]
    heads, bodies = masked(crc32c(sizes)), masked(crc32c(payloads))
    return [b"".join((n, h.tobytes(), p, c.tobytes())) for n, h, p, c in zip(sizes, heads, payloads, bodies, strict=True)]


def frame(payload: bytes) -> bytes:
    return frames([payload])[0]


def unframe(stream, many: int = 1 << 22) -> Iterator[bytes]:
    """Payloads of an open file, checked together by the batch of ``many`` bytes; ValueError where a checksum or length does not hold."""
    heads, payloads, sums, size = [], [], [], 0

    def checked() -> Iterator[bytes]:
        if heads and (masked(crc32c([h[:8] for h in heads])) != [HEAD.unpack(h)[1] for h in heads]).any():
            raise ValueError("length checksum does not hold")
        if payloads and (masked(crc32c(payloads)) != sums).any():
            raise ValueError("payload checksum does not hold")
        yield from payloads

    while head := stream.read(HEAD.size):
        if len(head) < HEAD.size:
            raise ValueError("truncated record head")
        length = HEAD.unpack(head)[0]
        if length > LONGEST and masked(crc32c([head[:8]]))[0] != HEAD.unpack(head)[1]:
            raise ValueError("length checksum does not hold")  # before so much is asked for
        payload, tail = stream.read(length), stream.read(4)
        heads.append(head)
        if len(payload) < length or len(tail) < 4:
            yield from checked()
            raise ValueError("payload checksum does not hold")
        payloads.append(payload)
        sums.append(struct.unpack("<I", tail)[0])
        size += length
        if size >= many:
            yield from checked()
            heads, payloads, sums, size = [], [], [], 0
    yield from checked()


def packed(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return META.pack(doc_id is not None, doc_id or 0, width) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, doc_id, width = META.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=META.size)


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        coder = encoder(tokenizer, keeps_space=True)
        end = np.array([end_id], coder.dtype).tobytes()
        width, files = coder.dtype.itemsize, None
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        system, root = fs.FileSystem.from_uri(folder)
        name, at, docs, tokens = f"part-{part:06d}-{attempt}", 0, 0, 0
        for batch in batches:
            _, offs = utf8(batch.column("text"))
            for a, b in chunks(offs, 2 << 20):
                ids = coder.encode(batch.column("text").slice(a, b - a))
                if files is None:
                    system.create_dir(root, recursive=True)
                    files = [system.open_output_stream(f"{root}/{name}.{x}") for x in ("rec", "idx")]
                keys = batch.column("doc_id").slice(a, b - a).to_pylist()
                records = frames([packed(doc_id, x + end, width) for doc_id, x in zip(keys, ids, strict=True)])
                for doc_id, x, record in zip(keys, ids, records, strict=True):
                    n = len(x) // width + 1
                    files[0].write(record)
                    files[1].write(struct.pack("<qqqq", doc_id or 0, at, tokens, n))
                    at, docs, tokens = at + len(record), docs + 1, tokens + n
        if files:
            for stream in files:
                stream.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "rec": name, "docs": docs, "tokens": tokens}], pa.schema([("part", pa.int32()), ("rec", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    return write


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> list[tuple[str, int, int]]:
    """Writes all documents in ascending doc_id order; (file, tokens of the files before, documents) for each file.

    Only texts are shuffled (by range of doc_id), and tokenized once, after it. The list has a row for each partition.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    parts = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    done = sorted(parts.mapInArrow(_writer(folder, tokenizer, end_id), MANIFEST).collect())
    out, before = [], 0
    for r in done:
        out.append((r.rec, before, r.docs))
        before += r.tokens
    if out:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        with system.open_output_stream(f"{root}/manifest.json") as stream:  # for other readers: files in order
            stream.write(json.dumps([dict(zip(("file", "first_token", "documents"), x, strict=True)) for x in out]).encode())
    return out


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start, cols = row["before"], ([], [], [], [])
                with system.open_input_stream(f"{root}/{row['rec']}.rec", buffer_size=1 << 20) as stream:
                    for payload in unframe(stream):
                        doc_id, ids = unpack(payload)
                        for c, v in zip(cols, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                            c.append(v)
                        start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read


def read_records(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """Every record of the files, checked: doc_id, start, n_tokens, ids_crc32."""
    table = spark.createDataFrame([x[:2] for x in files], "rec string, before long")
    return table.repartition(max(1, len(files))).mapInArrow(_reader(folder), READ)


def read_one(folder: str, rec: str, k: int) -> tuple[int | None, np.ndarray]:
    """The k-th record of a file by its index alone, as a shuffled read does."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{root}/{rec}.idx") as index:
        index.seek(32 * k)
        at = struct.unpack("<qqqq", index.read(32))[1]
    with system.open_input_file(f"{root}/{rec}.rec") as stream:
        stream.seek(at)
        return unpack(next(unframe(stream)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_dir(spark, "records")
    files = write_records(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_records(spark, folder, files)
