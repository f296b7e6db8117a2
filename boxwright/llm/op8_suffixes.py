"""Removal of repeated 50-byte strings by a depth-limited radix sort of suffixes.

Suffixes are only told apart through their first ``LENGTH`` bytes. Most-significant digit first: the first digit of a
suffix is a ``DIGIT``-byte string at a place that its own 50 bytes choose (the least hash among their ``DIGIT``-byte
strings), so one digit serves a run of neighbouring suffixes; groups with one member are finished there. The next pass
sorts the rest by all that such a run covers, and the last by the whole 50 bytes of each suffix that is still open;
equal groups are then exactly the repeated windows. See ``_repeats`` for the exchanges.

Defined results: null text is empty; documents under 50 bytes keep all; rows with equal doc_id do not remove each
other's bytes; a null doc_id is the smallest; an empty table gives an empty result. ``kept`` is binary, as a cut may
split a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._repeats import Bucket, Prefix, Repeats, spans_of, whole_windows, without_repeats
from boxwright.llm._shared import documents
from boxwright.llm._text import U64, mix

LENGTH, DIGIT = 50, 20
BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, by doubling."""
    have, out = 1, keys
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def units(buf: np.ndarray, offs: np.ndarray):
    return BYTE[buf], offs, None


def anchors(values: np.ndarray, offs: np.ndarray, prefix: Prefix):
    starts = whole_windows(offs, LENGTH)
    if not len(starts):
        return spans_of(starts, starts, starts.astype(U64), prefix, LENGTH)
    digit = mix(prefix.all(DIGIT))
    keys = digit & U64(0xFFFFFFFF00000000) | np.arange(len(digit), dtype=U64)
    anchor = (least(keys, LENGTH - DIGIT + 1)[starts] & U64(0xFFFFFFFF)).astype(np.int64)
    return spans_of(starts, anchor, mix(digit[anchor]), prefix, LENGTH)  # mixed anew: the least hashes are all small


def _finish(repeats: Repeats, bucket: Bucket, mask: np.ndarray | None) -> pa.Table:
    n, offs = len(bucket.table), bucket.offs
    removed, spans = np.zeros(n, np.int64), np.zeros(n, np.int64)
    kept_offs, kept = offs, bucket.buf
    if mask is not None:
        full = np.zeros(len(bucket.buf) + 1, bool)
        full[: min(len(mask), len(full))] = mask[: len(full)]
        full[-1] = False
        total = np.concatenate([[0], np.cumsum(full)])
        removed = total[offs[1:]] - total[offs[:-1]]
        head = full[:-1].copy()
        head[1:] &= ~full[:-2]
        inner = offs[:-1][np.diff(offs) > 0]
        head[inner] = full[inner]  # a run ends with its document
        heads = np.concatenate([[0], np.cumsum(head)])
        spans = heads[offs[1:]] - heads[offs[:-1]]
        kept = bucket.buf[~full[:-1]]
        kept_offs = np.concatenate([[0], np.cumsum(np.diff(offs) - removed)])
    texts = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(kept_offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(kept))])
    return pa.table({"doc_id": bucket.table.column("doc_id"), "n_bytes": np.diff(offs), "n_removed": removed, "n_spans": spans, "kept": texts.cast(pa.binary())})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """SCHEMA of each document, with the bytes that stay."""
    return without_repeats(docs, lambda dests: Repeats(LENGTH, units, anchors, True, dests), _finish, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
