"""Masked pseudo-likelihood: a bidirectional window network scores documents.

A word's probability is that of its class given its neighbours, times that of the word within its class. Classes: the
``TOP`` most frequent words of the corpus, each of its own, and ``RARE`` hashed classes for all others. The network
adds an embedding for each of the words at distance 1 and 2 on both sides (one table a place), applies tanh, and
predicts the class of the word between through a softmax. Within a hashed class a word has its share of the class's
occurrences in the corpus. So every word of the corpus has a probability of its own, and they sum to one.

Passes, each over all documents: exact word counts (packed blocks dealt by word hash); classes, a byte a word, as a
table; training in ``ROUNDS`` synchronous rounds, each over the documents that a hash gives it: documents are dealt by
hash to groups of about ``GROUP_WORDS`` words, every group makes an epoch of Adagrad from the last round's model, and the mean of the
groups' models (and of what Adagrad has seen), weighted by words, is the next; scoring, where each word is masked in
turn and the log-probabilities of the classes given both sides are summed; and the words within classes: blocks of
documents send their distinct words, dealt by word hash, are answered with the corpus counts, and sum the
logarithms of the shares for each document. Groups and their order follow from the documents alone, so scores do not
depend on how rows lie.

Every word is used in each pass. The vocabulary grows with the corpus, has no least count, and is never in one place;
the network does not grow: only it, the TOP words and the RARE class totals are broadcast, and it knows the neighbours
by their classes. Shares are summed as whole multiples of 1 / ``UNIT``, so that no order of tasks changes a score.
Defined results: null and empty texts have 0 words, log_prob 0 and a null mean; ties of frequency go to the smaller
hash; equal rows score equally; a very long text is scored whole and trained on in slices; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._repeats import dealt
from boxwright.llm._shared import documents, written
from boxwright.llm._text import U64, chunks, hashes, mix, utf8, words

TOP, RARE, DIM, PLACES, BATCH, RATE = 96, 32, 16, (-2, -1, 1, 2), 4096, 0.08
V = TOP + RARE
SHAPES = [(len(PLACES), V + 1, DIM), (DIM, V), (V,)]
SCORES = "doc_id long, key long, n_words long, log_prob double"
UNIT, BLOCK_WORDS = 1 << 24, 2_000_000
GROUP_WORDS, ROUNDS, FOLDS, SLICE, END = 2_000_000, 4, 64, 1 << 20, 255
TAILS = "block long, dest int, keys binary, word binary, n binary, docs binary, doc binary, times binary"


def _word_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    buf, offs = utf8(column)
    for a, b in chunks(offs):
        part, own = buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        s, e, doc = words(part, own)
        yield a, b, hashes(part, s, e), doc


def _counter(dests: int, flush: int = 4_000_000):
    def blocks(parts: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(parts), return_counts=True)
        to = dealt(word, dests)
        cuts = np.searchsorted(to, np.arange(dests + 1))
        rows = [(d, word[x:y].tobytes(), n[x:y].astype("<u4").tobytes()) for d, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["dest", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, _, h, _ in _word_hashes(batch.column("text")):
                parts.append(h)
                size += len(h)
                if size > flush:
                    yield blocks(parts)
                    parts, size = [], 0
        if size:
            yield blocks(parts)

    return run


def _top(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    word = np.concatenate([np.frombuffer(x, U64) for x in table.column("word").to_pylist()])
    n = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("n").to_pylist()])
    word, place = np.unique(word, return_inverse=True)
    total = np.bincount(place, n).astype(np.int64)
    best = np.lexsort((word, -total))[:TOP]
    return pa.table({"word": pa.array(word[best].view(np.int64)), "n": total[best]})


def vocabulary(text: DataFrame) -> np.ndarray:
    """Hashes of the TOP most frequent words, ascending."""
    dests = int(text.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = text.mapInArrow(_counter(dests), "dest int, word binary, n binary")
    rows = counted.groupBy("dest").applyInArrow(_top, "word long, n long").orderBy(F.desc("n"), "word").limit(TOP).collect()
    return np.sort(np.array([r.word for r in rows], np.int64).view(U64))


def classes(h: np.ndarray, top: np.ndarray) -> np.ndarray:
    out = TOP + (mix(h) % U64(RARE)).astype(np.int64)
    if len(top):
        at = np.minimum(np.searchsorted(top, h), len(top) - 1)
        out = np.where(top[at] == h, at, out)
    return out


def start() -> list[np.ndarray]:
    rng = np.random.default_rng(11)
    model = [rng.normal(0, 0.1, s).astype(np.float32) for s in SHAPES[:2]] + [np.zeros(SHAPES[2], np.float32)]
    model[0][:, V] = 0  # beyond a document's ends
    return model


def contexts(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Class at each place around every word; V beyond the document."""
    out = np.full((len(PLACES), len(word)), V, np.uint8)
    for k, o in enumerate(PLACES):
        a, b = (slice(max(0, -o), len(word) - max(0, o)), slice(max(0, o), len(word) + min(0, o)))
        if len(word) > abs(o):
            out[k, a] = np.where(doc[a] == doc[b], word[b], V).astype(np.uint8)
    return out


def forward(model: list[np.ndarray], ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden layer, and logits less their maximum."""
    emb, w, bias = model
    h = emb[0][ctx[0]]
    for k in range(1, len(PLACES)):
        h += emb[k][ctx[k]]
    np.tanh(h, out=h)
    z = h @ w
    z += bias
    z -= z.max(1, keepdims=True)
    return h, z


def train_step(model: list[np.ndarray], seen: list[np.ndarray], ctx: np.ndarray, target: np.ndarray) -> None:
    """One Adagrad step on the mean loss of a batch."""
    emb, w, _ = model
    h, p = forward(model, ctx)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True) * np.float32(1)
    p[np.arange(len(target)), target] -= 1
    p /= np.float32(len(target))
    dh = p @ w.T
    dh *= 1 - h * h
    d_emb = np.zeros_like(emb)
    for k in range(len(PLACES)):
        order = np.argsort(ctx[k], kind="stable")
        ids = ctx[k][order].astype(np.int64)
        cut = np.flatnonzero(np.diff(ids, prepend=-1))
        d_emb[k][ids[cut]] = np.add.reduceat(dh[order], cut)
    d_emb[:, V] = 0
    for x, s, g in zip(model, seen, (d_emb, h.T @ p, p.sum(0)), strict=True):
        s += g * g
        x -= np.float32(RATE) * g / (np.sqrt(s) + np.float32(1e-7))


def _classed(top):
    """Each text as one byte a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, h, doc in _word_hashes(batch.column("text")):
                word, n = classes(h, top.value).astype(np.uint8), np.bincount(doc, minlength=b - a)
                cut = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), pa.array([word[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary()), pa.array(n, pa.int64())], ["key", "classes", "n"])

    return run


MODEL = "fold int, group long, n long, weights binary, seen binary"


def _shaped(flat: np.ndarray) -> list[np.ndarray]:
    cuts = np.cumsum([int(np.prod(s)) for s in SHAPES])[:-1]
    return [x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, cuts), SHAPES, strict=True)]


def _learner(state):
    """One epoch over a group's documents in order of their keys, from the shared model."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        model, seen = ([x.copy() for x in part] for part in state.value)
        table = table.sort_by([("key", "ascending"), ("classes", "ascending")])
        parts = [np.frombuffer(x, np.uint8) for x in table.column("classes").to_pylist()]
        word = np.concatenate([y for x in parts for y in (x, [END])]).astype(np.uint8)  # an end is in no class
        doc = np.repeat(np.arange(len(parts)), [len(x) + 1 for x in parts])
        reach, total = max(PLACES), 0
        for a in range(0, len(word), SLICE):
            lo, hi = max(0, a - reach), min(len(word), a + SLICE + reach)
            w = np.where(word[lo:hi] == END, V, word[lo:hi])
            ctx = contexts(w, doc[lo:hi])[:, a - lo : a - lo + SLICE]
            own = np.flatnonzero(word[a : a + SLICE] != END)
            ctx, target = ctx[:, own], word[a : a + SLICE][own]
            for x in range(0, len(target), BATCH):
                train_step(model, seen, ctx[:, x : x + BATCH], target[x : x + BATCH])
            total += len(target)
        group = key[0].as_py()
        flat = [np.concatenate([x.ravel() for x in part]).astype("<f4").tobytes() for part in (model, seen)]
        return pa.table({"fold": pa.array([group % FOLDS], pa.int32()), "group": pa.array([group], pa.int64()), "n": pa.array([total], pa.int64()), **{c: pa.array([f], pa.binary()) for c, f in zip(("weights", "seen"), flat, strict=True)}})

    return run


def _folded(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums, weighted by words, of one fold's models in order of their groups."""
    table = table.sort_by("group")
    n = table.column("n").to_numpy()
    sums = [sum(k * np.frombuffer(x, "<f4").astype(np.float64) for k, x in zip(n.tolist(), table.column(c).to_pylist(), strict=True)) for c in ("weights", "seen")]
    return pa.table({"fold": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([int(n.sum())], pa.int64()), "weights": pa.array([sums[0].tobytes()], pa.binary()), "seen": pa.array([sums[1].tobytes()], pa.binary())})


def train(rows: DataFrame, top: np.ndarray) -> list[np.ndarray]:
    """The model after all rounds, from rows of text (and doc_id). At most FOLDS sums reach the driver in a round."""
    context = rows.sparkSession.sparkContext
    keyed = rows.select(F.xxhash64(*rows.columns).alias("key"), "text")
    table = written(keyed.mapInArrow(_classed(context.broadcast(top)), "key long, classes binary, n long").where("n > 0"), "classes")
    groups = -(-(table.agg(F.sum("n").alias("n")).first().n or 0) // GROUP_WORDS)
    model = start()
    seen = [np.zeros_like(x) for x in model]
    for r in range(ROUNDS if groups else 0):
        own = table.where(F.pmod(F.shiftright("key", 40), F.lit(ROUNDS)) == r).select(F.pmod("key", F.lit(groups)).alias("group"), "key", "classes")
        learnt = own.repartition(groups, "group").groupBy("group").applyInArrow(_learner(context.broadcast((model, seen))), MODEL)
        folds = sorted(learnt.groupBy("fold").applyInArrow(_folded, "fold int, n long, weights binary, seen binary").collect(), key=lambda f: f.fold)
        if n := sum(f.n for f in folds):
            model, seen = (_shaped(sum(np.frombuffer(f[c], "<f8") for f in folds) / n) for c in ("weights", "seen"))
    return model


def log_probs(model: list[np.ndarray], word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    ctx, out = contexts(word, doc), np.zeros(len(word))
    for x in range(0, len(word), BATCH):
        target = word[x : x + BATCH]
        _, z = forward(model, ctx[:, x : x + BATCH])
        hit = z[np.arange(len(target)), target]
        np.exp(z, out=z)
        out[x : x + BATCH] = hit - np.log(z.sum(1))
    return out


def _tails(top, dests: int):
    """Rows of a block of documents and a dest: its words beyond TOP, their counts, and the documents that hold each."""

    def packed(block: int, keys: list[np.ndarray], parts: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
        word, place = np.unique(np.concatenate(parts), return_inverse=True)
        to = dealt(word, dests)
        pair, times = np.unique(place.astype(U64) << U64(32) | np.concatenate(owners).astype(U64), return_counts=True)
        of, doc = (pair >> U64(32)).astype(np.int64), pair & U64(0xFFFFFFFF)
        docs, n = np.bincount(of, minlength=len(word)), np.bincount(place, minlength=len(word))
        cuts, ends = np.searchsorted(to, np.arange(dests + 1)), np.concatenate([[0], np.cumsum(docs)])
        rows, own = [], np.concatenate(keys).tobytes()
        for d, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if x < y:
                at = slice(ends[x], ends[y])
                rows.append((block, d, own, word[x:y].tobytes(), *(v.astype("<u4").tobytes() for v in (n[x:y], docs[x:y], doc[at], times[at]))))
                own = b""  # once in a block
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 6)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in TAILS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        keys, parts, owners, size, n = [], [], [], 0, 0
        for batch in batches:
            key = batch.column("key").to_numpy()
            for a, b, h, doc in _word_hashes(batch.column("text")):
                rare = classes(h, top.value) >= TOP
                keys.append(key[a:b])
                parts.append(h[rare])
                owners.append(doc[rare] + n)
                size, n = size + len(parts[-1]), n + b - a
                if size > BLOCK_WORDS:
                    yield packed(block, keys, parts, owners)
                    block, keys, parts, owners, size, n = block + 1, [], [], [], 0, 0
        if size:
            yield packed(block, keys, parts, owners)

    return run


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(RARE, np.int64)
    for batch in batches:
        for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
            total += np.bincount((mix(np.frombuffer(w, U64)) % U64(RARE)).astype(np.int64), np.frombuffer(n, "<u4"), RARE).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(RARE), pa.int32()), pa.array(total)], ["class", "n"])


def _shares(total):
    """For each block the logarithms of its words' shares, in multiples of 1 / UNIT."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, U64) for x in table.column("word").to_pylist()]
        word, place = np.unique(np.concatenate(parts), return_inverse=True)
        n = np.bincount(place, np.concatenate([np.frombuffer(x, "<u4") for x in table.column("n").to_pylist()]))
        share = np.rint(UNIT * np.log(n / total.value[(mix(word) % U64(RARE)).astype(np.int64)])).astype("<i4")
        answers = np.split(share[place], np.cumsum([len(x) for x in parts])[:-1])
        return pa.table({"block": table.column("block"), "dest": table.column("dest"), "share": pa.array([x.tobytes() for x in answers], pa.binary())})

    return run


def _gathered(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    """Sum of the shares of each document in a block."""
    share = dict(zip(right.column("dest").to_pylist(), right.column("share").to_pylist(), strict=True))
    keys = np.frombuffer(b"".join(left.column("keys").to_pylist()), "<i8")
    total = np.zeros(len(keys), np.int64)
    for dest, *held in zip(*(left.column(c).to_pylist() for c in ("dest", "docs", "doc", "times")), strict=True):
        docs, doc, times = (np.frombuffer(x, "<u4") for x in held)
        np.add.at(total, doc, np.repeat(np.frombuffer(share[dest], "<i4").astype(np.int64), docs) * times)
    return pa.table({"key": pa.array(keys), "within": pa.array(total)})


def within_classes(rows: DataFrame, top: np.ndarray) -> DataFrame:
    """key, within: the sum of log P(word | class) over a text's words, in multiples of 1 / UNIT, from rows of key and text."""
    context = rows.sparkSession.sparkContext
    dests = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tails = written(rows.select("key", "text").mapInArrow(_tails(context.broadcast(top), dests), TAILS), "tails")
    total = np.zeros(RARE)
    for r in tails.select("word", "n").mapInArrow(_class_counts, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        total[r["class"]] = r.n
    shares = tails.select("block", "dest", "word", "n").groupBy("dest").applyInArrow(_shares(context.broadcast(total)), "block long, dest int, share binary")
    held = tails.select("block", "dest", "keys", "docs", "doc", "times")
    sums = held.groupBy("block").cogroup(shares.groupBy("block")).applyInArrow(_gathered, "key long, within long")
    return sums.groupBy("key").agg(F.first("within").alias("within"))  # equal rows have equal sums


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, model = shared.value
        for batch in batches:
            n, score = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for a, b, h, doc in _word_hashes(batch.column("text")):
                word = classes(h, top)
                n[a:b] = np.bincount(doc, minlength=b - a)
                score[a:b] = np.bincount(doc, log_probs(model, word, doc), minlength=b - a)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(n), pa.array(score)], ["doc_id", "key", "n_words", "log_prob"])

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_prob (sum over words given both sides), mean_log_prob."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    text = rows.select("text")
    top = vocabulary(text)
    shared = docs.sparkSession.sparkContext.broadcast((top, train(rows.select("doc_id", "text"), top)))
    out = rows.mapInArrow(_scorer(shared), SCORES).join(within_classes(rows, top), "key", "left")
    out = out.withColumn("log_prob", F.col("log_prob") + F.coalesce("within", F.lit(0)) / F.lit(float(UNIT)))
    return out.select("doc_id", "n_words", "log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
