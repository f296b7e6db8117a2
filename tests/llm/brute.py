"""Plain restatements of what the operators must return."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def op6(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    wins = defaultdict(list)
    for i in range(len(words) - 2):
        wins[tuple(words[i : i + 3])].append(i)
    rep = {i + k for at in wins.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(rep), n < 50 or 100 * len(rep) > 50 * n)


def op8(rows):
    """rows of (doc_id, text) -> {(doc_id, text): (n_bytes, n_removed, n_spans, kept_sha256)}"""
    first, out = {}, []
    rows = order(rows)
    key = lambda d: -(1 << 70) if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], key(d))
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < key(d):
                gone[i : i + 50] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        runs = int(np.sum(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), runs, sha(kept)))
    return out


def op9(rows, length=20):
    first, out = {}, []
    for d, t in order(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            if k in first:
                gone[i : i + length] = [True] * length
            else:
                first[k] = True
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(text):
    return ITEM.findall((text or "").translate(LOW))


def op10(docs, items, window=10):
    wins = defaultdict(set)
    for k, (item, text) in enumerate(items):
        w = norm(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[i : i + n])].add((k, item))
    sizes = {len(k) for k in wins}
    out = []
    for d, t in docs:
        w, found = norm(t), set()
        hit = [False] * len(w)
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := wins.get(tuple(w[i : i + n])):
                    found |= got
                    hit[i : i + n] = [True] * n
        out.append((d, len(w), sum(hit), len(found), sha(",".join(sorted(str(i) for _, i in found))), any(hit)))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(s[::-1])) % 10 == 0


def op5(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    names = ("email", "ip", "card", "phone")
    said = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(out))
    return (*(sum(k == j for _, k, _ in out) for j in range(4)), sha(said)), said


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def op7(rows):
    """[(doc_id, cluster's least doc_id, links in documents)] by an inverted index."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s or [()]:
            holders[x].append(i)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        count = defaultdict(int)
        for x in s or [()]:
            for j in holders[x]:
                count[j] += 1
        for j, c in count.items():
            if j != i and c >= 0.8 * (len(s or [()]) + len(sets[j] or [()]) - c) - 1e-9:
                links[i] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, least[root(i)], links[i]) for i, (d, _) in enumerate(rows)]


def conversations(rows):
    """rows of (conv_id, turn, role, text) -> {conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}"""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(loss), sha(loss))
    return out


def op6_distances(rows, min_cell=200):
    """Rows of (lang, source, text) -> scaled squared distance of each, None where the base rule rejects: a plain numpy fit."""
    stats = [op6(t) for *_, t in rows]
    n = np.array([max(s[0], 1) for s in stats], float)
    x = np.stack([np.log1p(n), np.log1p([s[1] for s in stats] / n), np.sqrt([s[2] for s in stats] / n), np.sqrt([s[3] for s in stats] / np.sqrt(n)), np.sqrt([s[4] for s in stats] / n)], 1)
    cells = defaultdict(list)
    for i, (lang, source, _) in enumerate(rows):
        if not stats[i][5]:
            for c in ((lang, source), (lang,), ()):
                cells[c].append(i)
    rank = lambda v, q: np.quantile(v, q, axis=0, method="inverted_cdf")

    def fit(z):
        mid = rank(z, 0.5)
        w = np.expm1(mid[0])
        floor = np.diag(np.array([w**-0.5, w**-0.5 / 2, w**-0.5, w**-0.25, (6 / w) ** 0.5]) ** 2)
        mean, inv = mid, np.linalg.inv(np.diag((1.4826 * rank(abs(z - mid), 0.5)) ** 2) + floor)
        far = lambda y: np.einsum("ij,jk,ik->i", y - mean, inv, y - mean)
        for _ in range(3):
            d = far(z)
            core = z[d <= rank(d, 0.75)]
            mean, inv = core.mean(0), np.linalg.inv(np.cov(core.T, bias=True) + floor)
        return far, max(rank(far(z), 0.5) / 4.351, 1e-9)

    fits = {c: fit(x[at]) for c, at in cells.items() if len(at) >= min_cell or c == ()}
    out = []
    for i, (lang, source, _) in enumerate(rows):
        far, scale = next((fits[c] for c in ((lang, source), (lang,), ()) if c in fits), (None, None))
        out.append(None if stats[i][5] else far(x[i : i + 1])[0] / scale)
    return out


def cut_hits(text, items):
    """A text without the stretches of words inside item windows, and the share of its words that they cover."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    spans = [m.span() for m in TERM.finditer(low)]
    w = [low[a:b] for a, b in spans]
    hit = [False] * len(w)
    for item in items:
        s = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in item))
        n = min(10, len(s))
        wins = {tuple(s[i : i + n]) for i in range(len(s) - n + 1)} if s else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in wins:
                hit[i : i + n] = [True] * n
    out, at, i = [], 0, 0
    while i < len(w):
        if hit[i]:
            j = i
            while j + 1 < len(w) and hit[j + 1]:
                j += 1
            out.append(text[at : spans[i][0]])
            at, i = spans[j][1], j
        i += 1
    return "".join([*out, text[at:]]), (sum(hit) / len(w) if w else 0.0)
