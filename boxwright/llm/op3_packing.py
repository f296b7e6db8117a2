"""Packing along a space-filling curve: neighbouring documents share sequences.

Each document's hashed word counts (unit length) are projected to ``DIMS`` Gaussian directions, squeezed to ``BITS``
bits a dimension, and numbered along a Hilbert curve. Rows are range-sorted by that key; each partition lays its
documents end to end and cuts at every 4096 ids. What is left at a partition's end is cut into powers of two, which
need no padding, so no sequence is padded at all.

Defined results: null or empty text has the end id alone; ties of the key are ordered by doc_id, then text; equal rows
are packed each; an empty table has no piece; a text of any length is cut over as many sequences as it needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._shared import documents
from boxwright.llm._text import U64, chunks, hashes, utf8, words
from boxwright.llm._tokens import encoder

BUCKETS, DIMS, BITS, SEED = 512, 4, 10, 7
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer points (rows x dims), by Skilling's transposition."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[i] >> bit & 1
    return key


def curve_keys(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Hilbert key of each text."""
    n = len(offs) - 1
    s, e, doc = words(buf, offs)
    slot = (hashes(buf, s, e) % U64(BUCKETS)).astype(np.int64)
    counts = np.bincount(doc * BUCKETS + slot, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float64)
    length = np.sqrt((counts**2).sum(1, keepdims=True))
    flat = counts @ np.random.default_rng(SEED).standard_normal((BUCKETS, DIMS)) / np.maximum(length, 1)
    even = 1 / (1 + np.exp(-1.702 * flat))
    return hilbert(np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        keys = [curve_keys(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]) for a, b in chunks(offs)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(np.concatenate(keys) if keys else [], pa.int64())], ["doc_id", "text", "key"])


def _packer(tokenizer: str, end_id: int, size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, keeps_space=False)
        end, width = np.array([end_id], coder.dtype).tobytes(), coder.dtype.itemsize
        base, sequence, filled = TaskContext.get().partitionId() << 40, 0, 0
        open_rows: list[tuple] = []  # pieces of the sequence that is not full

        def row(doc, start, ids, total, seq, off):
            return doc, start, len(ids) // width, zlib.crc32(np.frombuffer(ids, coder.dtype).astype("<u4").tobytes()), total, base + seq, off, ids

        def batch_of(rows):
            kinds = [pa.int64()] * 7 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

        for batch in batches:
            _, offs = utf8(batch.column("text"))
            for a, b in chunks(offs, 2 << 20):
                out = []
                coded = coder.encode(batch.column("text").slice(a, b - a))
                for doc, ids in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), coded, strict=True):
                    ids += end
                    total, start = len(ids) // width, 0
                    while start < total:
                        take = min(total - start, size - filled)
                        open_rows.append((doc, start, ids[start * width : (start + take) * width], total))
                        start, filled = start + take, filled + take
                        if filled == size:
                            off = 0
                            for d, s, x, t in open_rows:
                                out.append(row(d, s, x, t, sequence, off))
                                off += len(x) // width
                            open_rows, sequence, filled = [], sequence + 1, 0
                if out:
                    yield batch_of(out)
        out, left, off = [], filled, 0
        room = 1 << left.bit_length() - 1 if left else 0
        for d, s, x, t in open_rows:
            while x:
                take = min(len(x) // width, room - off)
                out.append(row(d, s, x[: take * width], t, sequence, off))
                x, s, off, left = x[take * width :], s + take, off + take, left - take
                if off == room:
                    sequence, off, room = sequence + 1, 0, 1 << left.bit_length() - 1 if left else 0
        if out:
            yield batch_of(out)

    return pack


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096) -> DataFrame:
    """Pieces of all documents. Keys are cheap and computed before the range shuffle; each text is tokenized once, after it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    keyed = rows.mapInArrow(_with_key, "doc_id long, text string, key long")
    dealt = keyed.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "text")
    return dealt.select("doc_id", "text").mapInArrow(_packer(tokenizer, end_id, size), PIECES)


def pieces(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def digests(docs: DataFrame) -> DataFrame:
    return pieces(docs).drop("ids")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
