"""CRC-32C (Castagnoli) of many byte strings at once, in numpy.

Strings are cut into pieces of ``PIECE`` bytes that are run through the byte table in step, one vector operation a byte of
a piece; the pieces of a string are then joined by the linear map that appends PIECE zero bytes to a checksum.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: Fixed value: the polynomial, bits reversed.
POLY = 0x82F63B78
PIECE = 512


@cache
def table() -> np.ndarray:
    """Step of one byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ POLY, t >> 1).astype(np.uint32)
    return t


@cache
def skip(n: int) -> np.ndarray:
    """(4, 256): what the bytes of a register become after n zero bytes."""
    t, bits = table(), np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(n):
        bits = t[bits & 0xFF] ^ bits >> np.uint32(8)
    out = np.zeros((4, 256), np.uint32)
    for b in range(32):
        out[b // 8, (np.arange(256) >> b % 8 & 1) == 1] ^= bits[b]
    return out


def crc32c(strings: list[bytes]) -> np.ndarray:
    """Checksum of each string."""
    if not strings:
        return np.zeros(0, np.uint32)
    sizes = np.array([len(s) for s in strings], np.int64)
    data, first = np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes
    t, jump = table(), skip(PIECE)
    # the first piece of a string is the short one, so all that follow are whole
    count = np.maximum(-(-sizes // PIECE), 1)
    owner = np.repeat(np.arange(len(sizes)), count)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    short = sizes - (count - 1) * PIECE
    length = np.where(turn == 0, short[owner], PIECE)
    start = first[owner] + np.where(turn == 0, 0, short[owner] + (turn - 1) * PIECE)
    order = np.argsort(-length, kind="stable")  # the pieces still running are a prefix
    ends = np.searchsorted(-length[order], -np.arange(PIECE), "left")
    state = np.where(turn == 0, 0xFFFFFFFF, 0).astype(np.uint32)[order]
    at = start[order]
    for k in range(int(length.max(initial=0))):
        n = ends[k]
        state[:n] = t[(state[:n] ^ data[at[:n] + k]) & 0xFF] ^ state[:n] >> np.uint32(8)
    piece = np.empty_like(state)
    piece[order] = state
    head = np.cumsum(count) - count
    out = piece[head]
    for k in range(1, int(count.max())):
        go = np.flatnonzero(count > k)
        x = out[go]
        out[go] = jump[0, x & 0xFF] ^ jump[1, x >> 8 & 0xFF] ^ jump[2, x >> 16 & 0xFF] ^ jump[3, x >> 24] ^ piece[head[go] + k]
    return out ^ np.uint32(0xFFFFFFFF)
