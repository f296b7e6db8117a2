"""Exact, cached use of the public tokenizers: a text is cut only where its pre-tokenizer cannot look across."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from boxwright.llm._text import LOWER, U64, hashes, mix, segments, utf8

#: Bytes that may begin white space other than a blank or a line feed (or a mark that is not ordinary text).
_CHECK = np.zeros(256, bool)
_CHECK[[0x00, 0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x3C, 0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Second bytes after which such a first byte is white space (0xE2 also begins quotes: those texts merely go the slow way).
_SECOND = {0x3C: (0x7C,), 0xC2: (0x85, 0xA0), 0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}
_JOINED = 64


class Encoder:
    """ids of whole texts as little-endian 16- or 32-bit binaries.

    Byte-level files: between two non-space characters one blank (or line feed) always starts a new pre-token, and no
    match looks over it, so the pieces between are encoded apart and kept, by a 64-bit hash of their bytes. Texts with
    other white space go whole to the library. Files that drop white space are cut at each blank and line feed, and A-Z
    may be lower-cased first. New pieces are encoded many at once where the ids tell where each piece begins (or ends).
    ``cache`` bounds the kept pieces. Use encoder() to share one in a reused Python worker.
    """

    def __init__(self, path: str, keeps_space: bool, cache: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # control strings inside a text stay ordinary text
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.keeps_space, self.limit = keeps_space, cache
        self.begins, self.breaks, self.ends = (np.zeros(max(vocabulary.values()) + 1, bool) for _ in range(3))
        for token, i in vocabulary.items():
            self.begins[i], self.breaks[i], self.ends[i] = token[0] == "Ġ", token[0] == "Ċ", token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.keys, self.places = np.zeros(0, U64), np.zeros(0, np.int64)  # known pieces by ascending hash, and their numbers
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, pieces: list[str]) -> list[bytes]:
        return [x.tobytes() for x in self._library(pieces)]

    def _together(self, pieces: list[str], mark: np.ndarray, ending: bool, between: str) -> list[bytes]:
        """Ids of the pieces, from texts of many; mark tells the ids that begin (end) a piece."""
        out: list[bytes] = []
        groups = [pieces[k : k + _JOINED] for k in range(0, len(pieces), _JOINED)]
        for group, ids in zip(groups, self._library([between.join(g) for g in groups]), strict=True):
            at = np.flatnonzero(mark[ids])
            cuts = np.concatenate([[0], at + 1]) if ending else np.append(at, len(ids))
            if len(at) != len(group) or cuts[0] or cuts[-1] != len(ids):
                out += self._apart(group)
                continue
            raw, cuts = ids.tobytes(), (cuts * self.dtype.itemsize).tolist()
            out += [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of pieces: text after a blank (marked by one), after a line feed (with it), or at the start of a text."""
        at: dict[str, list[int]] = {}
        for k, p in enumerate(new):
            if self.keeps_space:
                kind = "blank" if p[0] == " " else "line" if p[0] == "\n" else "other"
            else:
                kind = "word" if p.isalpha() and p.islower() and max(p) < "ɐ" else "other"
            at.setdefault(kind, []).append(k)
        got: list[bytes] = [b""] * len(new)
        for kind, places in at.items():
            pieces = [new[k] for k in places]
            if kind == "other":
                ids = self._apart(pieces)
            else:
                mark = {"blank": self.begins, "line": self.breaks, "word": self.ends}[kind]
                ids = self._together(pieces, mark, kind == "word", " " if kind == "word" else "")
            for k, x in zip(places, ids, strict=True):
                got[k] = x
        return got

    def _rows(self, key: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each distinct piece; new ones are learnt."""
        at = np.searchsorted(self.keys, key)
        hit = self.keys[np.minimum(at, len(self.keys) - 1)] == key if len(self.keys) else np.zeros(len(key), bool)
        rows = np.empty(len(key), np.int64)
        rows[hit] = self.places[at[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            data = buf.tobytes()
            made = self._learn([data[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            count = np.array([len(x) for x in made], np.int64) // self.dtype.itemsize
            ids = np.frombuffer(b"".join(made), self.dtype)
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(ids), self.dtype)])
            self.flat[self.used : self.used + len(ids)] = ids
            self.start = np.concatenate([self.start, self.used + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.used += len(ids)
            rows[new] = np.arange(len(self.keys), len(self.keys) + len(new))
            self.keys, self.places = np.insert(self.keys, at[new], key[new]), np.insert(self.places, at[new], rows[new])
        return rows

    def _odd(self, buf: np.ndarray, offs: np.ndarray, space: np.ndarray) -> np.ndarray:
        """Texts that the library must see whole."""
        at = np.flatnonzero(_CHECK[buf])
        first, second = buf[at], buf[np.minimum(at + 1, len(buf) - 1)]
        bad = first < 0x20
        for byte, after in _SECOND.items() if self.keeps_space else ((0x3C, (0x7C,)),):
            bad |= (first == byte) & np.isin(second, after)
        if not self.keeps_space:
            bad &= first >= 0x20  # white space may be any: pieces are cut at blanks and line feeds alone
        places = [at[bad]]
        size = np.diff(offs)
        full = np.flatnonzero(size)
        if self.keeps_space:
            double = np.flatnonzero(space[:-1] & space[1:])
            places += [double, offs[:-1][full][space[offs[:-1][full]]], (offs[1:][full] - 1)[space[offs[1:][full] - 1]]]
        odd = np.zeros(len(size), bool)
        odd[np.searchsorted(offs, np.concatenate(places), "right") - 1] = True
        return odd

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text; null is empty."""
        buf, offs = utf8(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        n = len(offs) - 1
        if not len(buf):
            return [b""] * n
        if len(self.keys) > self.limit:
            self._forget()
        space = (buf == 0x20) | (buf == 0x0A)
        odd = self._odd(buf, offs, space)
        low = buf if self.keeps_space else LOWER[buf]
        s, e = segments(space, offs)
        doc = np.searchsorted(offs, s, "right") - 1
        keep = ~odd[doc]
        s, e, doc = s[keep], e[keep], doc[keep]
        h = hashes(low, s, e)
        front = s
        if self.keeps_space:
            inside = s > offs[doc]
            front = s - inside  # a piece begins with the blank or line feed before it
            h = mix(h + np.where(inside, buf[front], 0).astype(U64) + U64(1))
        key, head, number = np.unique(h, return_index=True, return_inverse=True)
        row = self._rows(key, low, front[head], e[head])[number]
        count = self.count[row]
        total = int(count.sum())
        ids = self.flat[np.repeat(self.start[row] - (np.cumsum(count) - count), count) + np.arange(total)]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(doc, count, minlength=n).astype(np.int64))]) * self.dtype.itemsize
        raw, cuts = ids.tobytes(), cuts.tolist()
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        slow = np.flatnonzero(odd)
        if len(slow):
            data = buf.tobytes()
            for d, x in zip(slow, self._apart([data[offs[d] : offs[d + 1]].decode() for d in slow]), strict=True):
                out[d] = x
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker's encoder for a file, with the pieces that earlier tasks have met."""
    if (path, keeps_space) not in _ENCODERS:
        _ENCODERS[path, keeps_space] = Encoder(path, keeps_space)
    return _ENCODERS[path, keeps_space]
