"""Vectorised text primitives over Arrow string columns: words, hashes and chunking without per-word Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: ``[^\x20\x09-\x0D]+`` splits at these bytes.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, a-z and every byte of a non-ASCII character are kept.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

U64 = np.uint64
_POWERS = np.ones(1, U64)
_BASE = U64(0x9E3779B97F4A7C15)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``limit`` bytes, so that temporary arrays stay in cache; one row may be longer."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b
        a = b


def powers(n: int) -> np.ndarray:
    """BASE**i modulo 2**64 for i < n."""
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 4096), _BASE, U64)
        steps[0] = 1
        _POWERS = np.cumprod(steps, dtype=U64)
    return _POWERS[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def segments(separator: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without a separator; runs also end at the row offsets."""
    n = len(separator)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~separator
    first, last = word.copy(), word.copy()
    first[1:] &= separator[:-1]
    last[:-1] &= separator[1:]
    cut = np.unique(offs[(offs > 0) & (offs < n)])
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of buf[start:end] for disjoint ascending non-empty segments."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    heads = np.cumsum(lens) - lens
    total = int(lens.sum())
    pos = np.arange(total) - np.repeat(heads, lens)
    values = (buf[pos + np.repeat(starts, lens)].astype(U64) + U64(1)) * powers(int(lens.max()))[pos]
    return mix(np.add.reduceat(values, heads) + lens.astype(U64) * U64(0xD6E8FEB86659FD93))


def words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all words."""
    starts, ends = segments(table[buf], offs)
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of values within each row of offs."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of every k consecutive values (len(h) - k + 1 of them), by doubling; not mixed."""
    if len(h) < k:
        return np.zeros(0, U64)
    n = len(h) - k + 1
    out, done, power, width = None, 0, h, 1
    while True:
        if k & width:
            part = power[done : done + n]
            out = part.copy() if out is None else out * U64(pow(int(_BASE), width, 1 << 64)) + part
            done += width
        width *= 2
        if width > k:
            return out
        half = width // 2
        power = power[:-half] * U64(pow(int(_BASE), half, 1 << 64)) + power[half:]


def union(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of n places covered by runs of the given length."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0
