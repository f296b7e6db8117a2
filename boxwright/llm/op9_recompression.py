"""Removal of repeated 20-word windows by recompression.

Rounds rename a document's words into ever longer symbols: first every maximal run of one word becomes a symbol; then
each round splits all symbols into a left and a right class by one bit of their name's hash and replaces every adjacent
(left, right) pair. A name is a 64-bit hash of what it replaces, so it is the same in the whole corpus without an
exchange of names. Whether a symbol arises depends only on a bounded stretch around it, which is tracked; so a
window whose words contain that stretch holds the symbol wherever the window occurs. The highest such symbol in a
window is its anchor: shared symbols reveal candidates, hashes of what they span verify long repeats at once, and only
windows at the edges of repeats are compared one by one (see ``_repeats``). Runs of higher symbols are not renamed:
windows there fall back to symbols of a lower level, at the last to a single word, so nothing is lost.

Defined results: null text has no words; documents under 20 words keep all; rows with equal doc_id do not remove each
other's words unless one starts before the other in the order of texts; a null doc_id is the smallest; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._repeats import Bucket, Prefix, Repeats, spans_of, whole_windows, without_repeats
from boxwright.llm._shared import documents
from boxwright.llm._text import U64, hashes, mix, words

LENGTH, ROUNDS = 20, 5
SCHEMA = "doc_id long, n_words long, n_removed long, kept string"
_PAIR = U64(0xD6E8FEB86659FD93)


def units(buf: np.ndarray, offs: np.ndarray):
    """Word hashes, word offsets of the rows, and the words' places."""
    s, e, doc = words(buf, offs)
    return hashes(buf, s, e), np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offs) - 1))]), (s, e)


def symbols(values: np.ndarray, offs: np.ndarray, rounds: int = ROUNDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level the names of all symbols, and the stretch [lo, hi) of words that each depends on; both ascend."""
    n = len(values)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    yield values, np.arange(n), np.arange(1, n + 1)
    new = np.ones(n, bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    size = np.diff(at, append=n)
    name = np.where(size > 1, mix(values[at] + size.astype(U64) * _PAIR), values[at])
    doc, lo, hi = doc[at], at - 1, at + size + 1  # a run depends on both neighbours; beyond a document nothing is known
    yield name, lo, hi
    for r in range(1, rounds + 1):
        right = (mix(name + U64(r * 0x9E3779B97F4A7C15 % (1 << 64))) & U64(1)).astype(bool)
        linked = doc[1:] == doc[:-1]
        pair = np.append(~right[:-1] & right[1:] & linked, False)
        at = np.flatnonzero(~np.concatenate([[False], pair[:-1]]))
        both, after, before = pair[at], np.minimum(at + 1, len(name) - 1), np.maximum(at - 1, 0)
        low = np.where(np.concatenate([[False], linked])[at], lo[before], offs[doc[at]] - 1)
        high = np.where(np.append(linked, False)[at], hi[after], offs[doc[at] + 1] + 1)
        lo = np.where(~both & right[at], np.minimum(low, lo[at]), lo[at])
        hi = np.where(both, hi[after], np.where(right[at], hi[at], np.maximum(high, hi[at])))
        name, doc = np.where(both, mix(mix(name[at]) + name[after] * _PAIR + U64(r)), name[at]), doc[at]
        yield name, lo, hi


def anchors(values: np.ndarray, offs: np.ndarray, prefix: Prefix):
    starts = whole_windows(offs, LENGTH)
    anchor, name = np.zeros(len(starts), np.int64), np.zeros(len(starts), U64)
    left = np.arange(len(starts))
    for level, (names, lo, hi) in reversed(list(enumerate(symbols(values, offs)))) if len(starts) else ():
        k = np.searchsorted(lo, starts[left])
        inside = k < len(lo)
        inside[inside] = hi[k[inside]] <= starts[left[inside]] + LENGTH
        done, k = left[inside], k[inside]
        anchor[done], name[done] = k + (level << 40), mix(names[k] + U64(level))
        left = left[~inside]
    return spans_of(starts, anchor, name, prefix, LENGTH)


def _finish(repeats: Repeats, bucket: Bucket, mask: np.ndarray | None) -> pa.Table:
    counts, removed, kept, base = [], [], [], 0
    for _, _, buf, offs in bucket.parts():
        values, at, (s, e) = units(buf, offs)
        gone = np.zeros(len(values), bool)
        if mask is not None and base < len(mask):
            part = mask[base : base + len(values)]
            gone[: len(part)] = part
        base += len(values)
        counts.append(np.diff(at))
        total = np.concatenate([[0], np.cumsum(gone)])
        removed.append(total[at[1:]] - total[at[:-1]])
        # the bytes of kept words and one blank after each but a document's last
        s, e, doc = s[~gone], e[~gone], np.repeat(np.arange(len(offs) - 1), np.diff(at))[~gone]
        size = e - s + 1
        out_at = np.cumsum(size) - size
        out = np.full(int(size.sum()), 0x20, np.uint8)
        if len(s):
            src = np.arange(int(size.sum()) - len(s)) + np.repeat(s - (np.cumsum(size - 1) - (size - 1)), size - 1)
            blank = np.zeros(len(out), bool)
            blank[out_at + size - 1] = True
            out[~blank] = buf[src]
            last = np.append(doc[1:] != doc[:-1], True)
            keep = np.ones(len(out), bool)
            keep[(out_at + size - 1)[last]] = False
            out = out[keep]
            size = size - last
        offs_out = np.concatenate([[0], np.cumsum(np.bincount(doc, size, minlength=len(offs) - 1).astype(np.int64))])
        kept.append(pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [None, pa.py_buffer(offs_out.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out))]).cast(pa.string()))
    joined = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (counts, removed))
    return pa.table({"doc_id": bucket.table.column("doc_id"), **dict(zip(("n_words", "n_removed"), joined, strict=True)), "kept": pa.chunked_array(kept, pa.string())})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """SCHEMA of each document: its words, how many go, and the text of the words that stay, joined by one blank."""
    return without_repeats(docs, lambda dests: Repeats(LENGTH, units, anchors, False, dests), _finish, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))
