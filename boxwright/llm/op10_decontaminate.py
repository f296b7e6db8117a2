"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

Items are lower-cased word sequences, dealt to blocks of about ``max_words`` words (longer items in pieces that overlap
by a window less one word). Blocks are outermost: for one block after the other the driver holds its texts, sends them
to the workers, and each worker builds one automaton over them (an own separator after each piece) and streams
its documents through it: the state and the matched length after each word tell every item window that ends there. A
numpy pass first finds the runs of words that occur in items at all, so the automaton only walks runs that are as long as
the shortest window. With one block the pass gives the result; with more, each gives a table of the documents
that it hits, and these are merged by document. So the test items have no limit of size, and one automaton is alive a worker.

A window: ``window`` consecutive item words; a shorter item is one window. Defined results: null and empty texts or items
have no words; equal items each count; rows with equal doc_id are scanned each, equal rows alike; with no items nothing
is hit; windows that overlap or repeat count a word once; very long texts are walked word by word, as a whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from boxwright.llm._shared import documents, written
from boxwright.llm._text import LOWER, NOT_ALNUM, chunks, hashes, sums, utf8, words

WINDOW, MAX_WORDS, MAX_BYTES = 10, 500_000, 16 << 20
FOUND = "n_words long, n_hit long, n_items long, items_sha256 string, longest long, cuts array<bigint>"
HITS = "block int, k1 long, k2 long, spans array<bigint>, items array<bigint>, names array<string>, longest long"


def normalised(text: str) -> list[str]:
    buf, offs = utf8(pa.array([text or ""]))
    low = LOWER[buf].tobytes()
    s, e, _ = words(LOWER[buf], offs, NOT_ALNUM)
    return [low[a:b].decode() for a, b in zip(s, e, strict=True)]


class Automaton:
    """Suffix automaton of several word sequences; states know the windows that end in them."""

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.next, self.link, self.len = [{}], [-1], [0]
        last = 0
        for k, (_, seq) in enumerate(items):
            for w in (*seq, -1 - k):  # the separator occurs once, so no match spans two items
                last = self._add(last, w)
        self.window = window
        self.full: dict[int, set] = {}  # state that holds a window of full length -> items with it
        self.short: dict[int, list[tuple[int, object]]] = {}  # state -> (length, item) of items shorter than a window
        for item, seq in items:
            state, n = 0, 0
            for w in seq:
                state, n = self.step(state, n, w)
                if n >= window:
                    self.full.setdefault(self.up(state, window), set()).add(item)
            if 0 < len(seq) < window:
                self.short.setdefault(self.up(state, len(seq)), []).append((len(seq), item))
        self.least = min((min(len(s), window) for _, s in items if s), default=0)
        self.chain: dict[int, list[tuple[int, object]]] = {}

    def _add(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nxt[p].get(w) == q:
                    nxt[p][w] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        return cur

    def step(self, state: int, n: int, w: int) -> tuple[int, int]:
        """State and length of the longest suffix of the read words that is in some item."""
        nxt = self.next
        while w not in nxt[state]:
            if not state:
                return 0, 0
            state = self.link[state]
            n = self.len[state]
        return nxt[state][w], n + 1

    def up(self, state: int, n: int) -> int:
        """The state of the suffix of length n."""
        while self.len[self.link[state]] >= n:
            state = self.link[state]
        return state

    def shorts(self, state: int) -> list[tuple[int, object]]:
        """(length, item) of the short items that are suffixes of the state's words."""
        if not self.short:
            return []
        if state not in self.chain:
            out, s = [], state
            while s > 0:
                out += self.short.get(s, [])
                s = self.link[s]
            self.chain[state] = out
        return self.chain[state]

    def scan(self, seq: list[int], at: int, spans: list[tuple[int, int]], found: set) -> int:
        """Adds the windows in seq (whose first word is the document's at-th) to spans and found; the longest match."""
        state = n = longest = 0
        window, nxt = self.window, self.next
        for i, w in enumerate(seq, at + 1):
            if w in nxt[state]:
                state, n = nxt[state][w], n + 1
            else:
                state, n = self.step(state, n, w)
            longest = max(longest, n)
            if n >= window and (items := self.full.get(self.up(state, window))):
                spans.append((i - window, i))
                found.update(items)
            for m, item in self.shorts(state):
                if m <= n:
                    spans.append((i - m, i))
                    found.add(item)
        return longest


class Matcher:
    """The automaton of a block's items, and the words' hashes."""

    def __init__(self, items: list[tuple[object, list[str]]], window: int):
        vocabulary = sorted({w for _, seq in items for w in seq})
        raw = [w.encode() for w in vocabulary]
        ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
        hashed = hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends) if raw else np.zeros(0, np.uint64)
        order = np.argsort(hashed)
        self.hashed, self.ids = hashed[order], order.tolist()
        self.words = [raw[i] for i in self.ids]  # a hash is only a hint: the bytes are compared
        number = {w: i for i, w in enumerate(vocabulary)}
        self.automaton = Automaton([(item, [number[w] for w in seq]) for item, seq in items], window)
        self.least = self.automaton.least

    def scan(self, buf: np.ndarray, offs: np.ndarray):
        """Per text: number of words, merged hit spans (as word numbers), items, longest match; with the words' places."""
        low = LOWER[buf]
        s, e, doc = words(low, offs, NOT_ALNUM)
        n = len(offs) - 1
        count = np.bincount(doc, minlength=n)
        first = np.cumsum(count) - count
        hits: dict[int, tuple[list, set, int]] = {}
        if len(self.hashed) and len(s):
            h = hashes(low, s, e)
            place = np.minimum(np.searchsorted(self.hashed, h), len(self.hashed) - 1)
            known = self.hashed[place] == h
            edge = np.flatnonzero(np.diff(known.astype(np.int8), prepend=0, append=0) | np.append(np.diff(doc, prepend=-1) != 0, True))
            data = low.tobytes()
            runs = [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if b - a >= self.least and known[a]]
            if runs:
                coded = []
                for a, b in runs:
                    seq = [self.ids[k] if data[x:y] == self.words[k] else -1 << 40 for k, x, y in zip(place[a:b].tolist(), s[a:b].tolist(), e[a:b].tolist(), strict=True)]
                    coded.append((int(doc[a]), int(a - first[doc[a]]), seq))
                for d, at, seq in coded:
                    spans, found, longest = hits.setdefault(d, ([], set(), 0))
                    best = self.automaton.scan(seq, at, spans, found)
                    hits[d] = (spans, found, max(longest, best))
        return count, first, s, e, hits


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


#: The matcher of the block that this process scans for; one at a time.
_MATCHER: dict[str, Matcher] = {}


def _matcher(key: str, items, window: int) -> Matcher:
    if key not in _MATCHER:
        _MATCHER.clear()
        _MATCHER[key] = Matcher([((r, name), text.split(" ")) for r, name, text in items.value], window)
    return _MATCHER[key]


def _results(part: np.ndarray, own: np.ndarray, count: np.ndarray, first: np.ndarray, s: np.ndarray, e: np.ndarray, hits: dict) -> list[pa.Array]:
    """FOUND of each text from its hits."""
    n, lead = len(own) - 1, (part & 0xC0) != 0x80
    n_hit, n_items, longest = (np.zeros(n, np.int64) for _ in range(3))
    digest, cuts = [hashlib.sha256(b"").hexdigest()] * n, [[]] * n
    for d, (spans, found, best) in hits.items():
        runs = merged(spans)
        n_hit[d], n_items[d], longest[d] = sum(y - x for x, y in runs), len(found), best
        digest[d] = hashlib.sha256(",".join(sorted(str(i) for _, i in found)).encode()).hexdigest()
        if runs:
            chars = np.cumsum(lead[own[d] : own[d + 1]])  # code points up to each byte
            cuts[d] = [int(v) for x, y in runs for v in (chars[s[first[d] + x] - own[d]] - 1, chars[e[first[d] + y - 1] - 1 - own[d]])]
    return [*(pa.array(x, pa.int64()) for x in (count, n_hit, n_items)), pa.array(digest), pa.array(longest, pa.int64()), pa.array(cuts, pa.list_(pa.int64()))]


_NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _scanner(key: str, items, window: int):
    """All rows, with their results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(key, items, window)
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            for a, b in chunks(offs):
                part, own = buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *_results(part, own, *matcher.scan(part, own))], [*batch.schema.names, *_NAMES])

    return run


def _hitter(key: str, items, window: int, block: int):
    """HITS of the rows that the block hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(key, items, window)
        for batch in batches:
            buf, offs = utf8(batch.column("text"))
            for a, b in chunks(offs):
                _, _, _, _, hits = matcher.scan(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                rows = [(block, batch.column("k1")[a + d].as_py(), batch.column("k2")[a + d].as_py(), [v for s in merged(spans) for v in s], *zip(*((r, str(i)) for r, i in sorted(found, key=lambda x: x[0])), strict=True), best) for d, (spans, found, best) in hits.items() if found]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], [c.split()[0] for c in HITS.split(", ")])

    return run


def _merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows with the hits of all blocks."""
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        at = batch.schema.get_field_index("hits")
        rest = [c for k, c in enumerate(batch.columns) if k != at]
        names = [n for n in batch.schema.names if n != "hits"]
        for a, b in chunks(offs):
            part, own = buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
            s, e, doc = words(LOWER[part], own, NOT_ALNUM)
            count = np.bincount(doc, minlength=b - a)
            hits = {}
            for d, blocks in enumerate(batch.columns[at].slice(a, b - a).to_pylist()):
                if blocks:
                    spans = [s_ for h in blocks for s_ in zip(h["spans"][::2], h["spans"][1::2], strict=True)]
                    hits[d] = (spans, {x for h in blocks for x in zip(h["items"], h["names"], strict=True)}, max(h["longest"] for h in blocks))
            yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in rest), *_results(part, own, count, np.cumsum(count) - count, s, e, hits)], [*names, *_NAMES])


def _pieces(window: int, size: int):
    """Normalised words of each item, joined by a blank, in pieces of at most ``size`` words that overlap by window - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seq = normalised(text)
                for a in range(0, max(len(seq) - window + 1, min(len(seq), 1)), max(size - window + 1, 1)):
                    part = seq[a : a + max(size, window)]
                    out.append((item, " ".join(part), len(part)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)], ["item", "text", "words"])

    return run


def item_blocks(benchmark: DataFrame, window: int, max_words: int, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, int]:
    """block, row (a number of the item), item, text of the items' pieces, and the number of blocks; items without words go.

    Pieces are dealt to blocks by a hash, and there are enough blocks that one holds about max_words words and max_bytes.
    """
    rows = benchmark.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"))
    rows = rows.select(F.concat_ws("\t", F.col("row").cast("string"), F.coalesce("name", F.lit("None"))).alias("item"), "text")
    pieces = written(rows.mapInArrow(_pieces(window, max(window, max_words // 8)), "item string, text string, words long"), "items")
    total = pieces.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()
    blocks = max(1, -(-total.words // max_words), -(-total.size // max_bytes))
    split = F.split("item", "\t", 2)
    return pieces.select(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).cast("int").alias("block"), split[0].cast("long").alias("row"), split[1].alias("item"), "text"), blocks


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS, cut: bool = False) -> DataFrame:
    """doc_id, text, row (a struct of all other columns) and FOUND of each row: its words, hit words, items, longest match, and
    ``cuts``, starts and ends (code points) of the hit runs; with ``cut`` the text comes without these runs."""
    context = docs.sparkSession.sparkContext
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"))
    items, blocks = item_blocks(benchmark, window, max_words)

    def held(b: int):
        """One block's items; the driver holds no more at a time."""
        return uuid.uuid4().hex, context.broadcast([(r.row, r.item, r.text) for r in items.where(F.col("block") == b).select("row", "item", "text").collect()])

    schema = StructType([*rows.schema, *_FOUND_SCHEMA])
    made = (lambda f: lambda batches: _cut(f(batches))) if cut else lambda f: f
    if blocks == 1:
        key, block = held(0)
        return rows.mapInArrow(made(_scanner(key, block, window)), schema)
    keyed = rows.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64("text", "doc_id", F.lit(1))})
    hits = None
    for b in range(blocks):
        key, block = held(b)
        found = written(keyed.select("text", "k1", "k2").mapInArrow(_hitter(key, block, window, b), HITS), "hits")
        block.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    per_doc = hits.dropDuplicates(["block", "k1", "k2"]).groupBy("k1", "k2").agg(F.collect_list(F.struct("spans", "items", "names", "longest")).alias("hits"))
    return keyed.join(per_doc, ["k1", "k2"], "left").select("doc_id", "text", "row", "hits").mapInArrow(made(_merger), schema)


_FOUND_SCHEMA = StructType([StructField(n, {"long": LongType(), "string": StringType(), "array<bigint>": ArrayType(LongType())}[k]) for n, k in (c.split() for c in FOUND.split(", "))])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def _without(cuts: list[int], text: str) -> str:
    out, at = [], 0
    for a, b in zip(cuts[::2], cuts[1::2], strict=True):
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with results, their texts without the hit runs.

    In the worker that found them: a step of its own in the same task would keep a second worker, with its memory.
    """
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts, cuts = batch.column(at), batch.column("cuts")
        hit = np.flatnonzero(np.diff(cuts.offsets.to_numpy()))
        if len(hit):
            new = texts.to_pylist()
            for d in hit.tolist():
                new[d] = _without(cuts[d].as_py(), new[d])
            batch = batch.set_column(at, "text", pa.array(new, texts.type))
        yield batch


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Documents without their hit runs; those of which more than the ``coverage`` share of words is hit go as a whole.

    All columns stay, whatever their names; n_chars (if there is one) follows the text where it was cut.
    """
    found = scan(docs, benchmark, window, max_words, cut=True).where(F.col("n_hit") <= F.lit(coverage) * F.col("n_words"))
    size = F.when(F.col("n_hit") > 0, F.length("text").cast("long"))
    columns = {"text": F.col("text")} | ({"n_chars": F.coalesce(size, F.col("row.n_chars").cast("long"))} if "n_chars" in docs.columns else {})
    return found.select(*(columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, documents(spark, sf_dir, "benchmark"))
