"""Windows of a fixed length that occur earlier in the corpus, over buckets of documents in doc_id order.

The front end (bytes or words) names, for every window, an *anchor* inside it that depends on the window's content
alone; consecutive windows with one anchor form a *span*. Three passes over the same text exchange (which Spark reuses
within the one plan) and two exchanges of packed binary blocks settle every window:

1. each bucket sends its distinct (anchor, span) hashes, dealt by anchor. A receiver answers with a code an entry:
   the span occurs in an earlier bucket (all its windows are repeats); or it is the first of several spans around its
   anchor, so single windows may be shared; or neither.
2. a bucket sends the hashes of the windows that are still open, dealt by window, and forwards what is settled.
   A receiver answers with a bit a window: it occurs in an earlier bucket.
3. the bucket removes what repeated windows cover.

Buckets are ranges of doc_id, so their order is that of the documents and no position travels. Frequent windows are one
entry a bucket however many documents hold them, so no receiver gets a hot group. Blocks are sized by the number of
buckets and receivers, both a multiple of parts_for(), which grows with the input. Anchors need 32 bits beside those that dealt
them (a collision only opens windows in vain), spans 48 more, windows 64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxwright.llm._shared import part_of, split_points
from boxwright.llm._text import _BASE, U64, chunks, mix, powers, utf8

_INVERSE = np.ones(1, U64)
SENT = "dest int, bucket int, kind int, a binary, b binary, c binary"
ANSWER = "bucket int, kind int, dest int, a binary, b binary"
CHUNK = 1 << 18


def inverse_powers(n: int) -> np.ndarray:
    global _INVERSE
    if len(_INVERSE) < n:
        steps = np.full(max(n, 1 << 19), pow(int(_BASE), -1, 1 << 64), U64)
        steps[0] = 1
        _INVERSE = np.cumprod(steps, dtype=U64)
    return _INVERSE[:n]


class Prefix:
    """Hashes of any stretch of values, equal for equal content wherever it starts."""

    def __init__(self, values: np.ndarray):
        self.total = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(len(values)), out=self.total[1:])
        self.undo = inverse_powers(len(values) + 1)

    def all(self, length: int) -> np.ndarray:
        n = len(self.total) - length
        return (self.total[length:] - self.total[:n]) * self.undo[:n]

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.total[ends] - self.total[starts]) * self.undo[starts]


def whole_windows(offs: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows that lie within one row."""
    counts = np.maximum(np.diff(offs) - length + 1, 0)
    total = int(counts.sum())
    return np.arange(total) + np.repeat(offs[:-1] - (np.cumsum(counts) - counts), counts)


def spans_of(starts: np.ndarray, anchor: np.ndarray, name: np.ndarray, prefix: Prefix, length: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows with one anchor: name of the anchor, hash of all that the run covers, first, number."""
    if not len(starts):
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(at, append=len(starts))
    first = starts[at]
    content = prefix.at(first, first + count - 1 + length)
    return name[at], mix(content + count.astype(U64) * U64(0xD6E8FEB86659FD93)), first, count


class Bucket:
    """The documents of one bucket in doc_id order (null first), then text."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
        self.table = table.take(order)
        self.buf, self.offs = utf8(self.table.column("text"))
        if len(self.buf) >= 1 << 32:
            raise ValueError("a bucket holds 4 GiB of text or more, beyond its 32-bit places: raise spark.sql.shuffle.partitions")
        ids = self.table.column("doc_id").to_numpy(zero_copy_only=False)
        new = np.ones(len(ids), bool)
        if len(ids):
            new[1:] = ~((ids[1:] == ids[:-1]) | ((ids[1:] != ids[1:]) & (ids[:-1] != ids[:-1])))
        self.rank = np.cumsum(new)

    def parts(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for a, b in chunks(self.offs, CHUNK):
            yield a, b, self.buf[self.offs[a] : self.offs[b]], self.offs[a : b + 1] - self.offs[a]


def dealt(high: np.ndarray, dests: int) -> np.ndarray:
    """Receiver by the high 32 bits of ascending hashes; ascending too."""
    return ((high >> U64(32)) * U64(dests) >> U64(32)).astype(np.int64)


class Repeats:
    """units(buf, offs) -> values, unit offsets, own; anchors(values, unit offsets, prefix) -> as spans_of()."""

    def __init__(self, length: int, units: Callable, anchors: Callable, strict: bool, dests: int):
        #: strict: only documents with a smaller doc_id count; else an earlier start in the same document does too.
        self.length, self.units, self.anchors, self.strict, self.dests = length, units, anchors, strict, dests

    # what a bucket knows by itself, the same in every pass
    def entries(self, bucket: Bucket) -> dict:
        got, base = [], 0
        for a, _, buf, offs in bucket.parts():
            values, at, _ = self.units(buf, offs)
            name, content, first, count = self.anchors(values, at, Prefix(values))
            rank = bucket.rank[a + np.searchsorted(at, first, "right") - 1]
            got.append((name, content, first + base, count, rank))
            base += len(values)
        name, content, first, count, rank = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, U64),) * 2 + (np.zeros(0, np.int64),) * 3
        _, head, entry = np.unique(mix(name + mix(content)), return_index=True, return_inverse=True)
        order = np.argsort(name[head], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return {"name": name[head[order]], "content": content[head[order]], "head": head[order], "entry": place[entry], "first": first, "count": count, "rank": rank}

    def send(self, key, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        e = self.entries(Bucket(table))
        to = dealt(e["name"], self.dests)
        rows = []
        for d in np.unique(to).tolist():
            a, b = np.searchsorted(to, [d, d + 1])
            c = e["content"][a:b]
            rows.append((d, number, 1, (e["name"][a:b] & U64(0xFFFFFFFF)).astype("<u4").tobytes(), (c & U64(0xFFFFFFFF)).astype("<u4").tobytes(), (c >> U64(48)).astype("<u2").tobytes()))
        return _table(rows, SENT)

    @staticmethod
    def answer(key, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        name, low, high = (np.concatenate([np.frombuffer(r[c], t) for r in rows]).astype(U64) for c, t in (("a", "<u4"), ("b", "<u4"), ("c", "<u2")))
        content = mix(name ^ mix(low << U64(16) | high))
        order = np.argsort(content, kind="stable")  # rows are in bucket order, so the first of equals is the earliest
        first = np.ones(len(order), bool)
        first[order[1:]] = content[order[1:]] != content[order[:-1]]
        _, group, number = np.unique(name[first], return_inverse=True, return_counts=True)
        code = np.ones(len(name), np.uint8)
        code[first] = np.where(number[group] > 1, 2, 0)
        at = np.cumsum([0, *(len(r["a"]) // 4 for r in rows)])
        return _table([(r["bucket"], 1, r["dest"], code[at[k] : at[k + 1]].tobytes(), None) for k, r in enumerate(rows)], ANSWER)

    def opened(self, bucket: Bucket, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the open windows, each window's number in them, its start and rank; the first window of each hash."""
        hashed, starts, ranks, base = [], [], [], 0
        for a, _, buf, offs in bucket.parts() if len(first) else ():
            values, at, _ = self.units(buf, offs)
            x, y = np.searchsorted(first, [base, base + len(values)])
            if x < y:
                own = np.repeat(first[x:y] - base - (np.cumsum(count[x:y]) - count[x:y]), count[x:y]) + np.arange(count[x:y].sum())
                hashed.append(mix(Prefix(values).at(own, own + self.length)))
                starts.append(own + base)
                ranks.append(bucket.rank[a + np.searchsorted(at, own, "right") - 1])
            base += len(values)
        if not hashed:
            return np.zeros(0, U64), *(np.zeros(0, np.int64),) * 4
        values, head, number = np.unique(np.concatenate(hashed), return_index=True, return_inverse=True)
        return values, number, np.concatenate(starts), np.concatenate(ranks), head

    def open(self, key, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(answers) or not len(table):
            return _table([], SENT)
        number, bucket = key[0].as_py(), Bucket(table)
        e = self.entries(bucket)
        code = np.frombuffer(b"".join(r["a"] for r in sorted(answers.to_pylist(), key=lambda r: r["dest"])), np.uint8)[e["entry"]]
        head = e["head"][e["entry"]]
        gone = (code == 1) | (e["rank"] > e["rank"][head] if self.strict else np.arange(len(head)) > head)
        pending = (code == 2) & ~gone
        first, count = e["first"][pending], e["count"][pending]
        start, end = e["first"][gone], e["first"][gone] + e["count"][gone] - 1 + self.length
        if len(start):  # spans come in ascending order: join those that touch
            reach = np.maximum.accumulate(end)
            new = np.ones(len(start), bool)
            new[1:] = start[1:] > reach[:-1]
            at = np.flatnonzero(new)
            start, end = start[at], reach[np.append(at[1:], len(reach)) - 1]
        rows = [(number % self.dests, number, 0, np.stack([start, end]).astype("<u4").tobytes(), np.stack([first, count]).astype("<u4").tobytes(), None)]
        values = self.opened(bucket, first, count)[0]
        to = dealt(values, self.dests)
        for d in np.unique(to).tolist():
            a, b = np.searchsorted(to, [d, d + 1])
            rows.append((d, number, 2, values[a:b].astype("<u8").tobytes(), None, None))
        return _table(rows, SENT)

    @staticmethod
    def settle(key, table: pa.Table) -> pa.Table:
        every = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        rows = [r for r in every if r["kind"] == 2]
        out = [(r["bucket"], 0, -1, r["a"], r["b"]) for r in every if r["kind"] == 0]
        if rows:
            values = np.concatenate([np.frombuffer(r["a"], "<u8") for r in rows])
            order = np.argsort(values, kind="stable")
            earlier = np.zeros(len(values), bool)
            earlier[order[1:]] = values[order[1:]] == values[order[:-1]]
            at = np.cumsum([0, *(len(r["a"]) // 8 for r in rows)])
            out += [(r["bucket"], 2, r["dest"], np.packbits(earlier[at[k] : at[k + 1]]).tobytes(), np.array([at[k + 1] - at[k]], "<i8").tobytes()) for k, r in enumerate(rows)]
        return _table(out, ANSWER)

    def removed(self, bucket: Bucket, answers: pa.Table) -> np.ndarray | None:
        """Mask over the bucket's units that repeated windows cover; None if there are none."""
        rows = answers.to_pylist()
        forward = next((r for r in rows if r["kind"] == 0), None)
        if forward is None:
            return None
        start, end = np.frombuffer(forward["a"], "<u4").reshape(2, -1).astype(np.int64)
        first, count = np.frombuffer(forward["b"], "<u4").reshape(2, -1).astype(np.int64)
        values, number, starts, ranks, head = self.opened(bucket, first, count)
        if len(values):
            bits = [np.unpackbits(np.frombuffer(r["a"], np.uint8), count=int(np.frombuffer(r["b"], "<i8")[0])) for r in sorted(rows, key=lambda r: r["dest"]) if r["kind"] == 2]
            earlier = np.concatenate(bits).astype(bool)[number]
            own = head[number]
            gone = starts[earlier | (ranks > ranks[own] if self.strict else np.arange(len(number)) > own)]
            start, end = np.concatenate([start, gone]), np.concatenate([end, gone + self.length])
        if not len(start):
            return None
        size = int(end.max()) + 1
        return np.cumsum(np.bincount(start, minlength=size) - np.bincount(end, minlength=size)) > 0


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [x.split() for x in schema.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(names, columns, strict=True)})


def parts_for(docs: DataFrame, size: int = 64 << 20, most: int = 4096) -> int:
    """spark.sql.shuffle.partitions, or more where a part would hold over ``size`` bytes of what the plan is estimated to read.

    Beyond ``most`` the list of split points would burden the plan, and parts grow with the input.
    """
    stated = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    estimate = stated if stated < 1 << 60 else 0  # an unknown size is stated as a huge one
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(most, -(-estimate // size)))


def without_repeats(docs: DataFrame, repeats: Callable[[int], Repeats], finish: Callable, schema: str) -> DataFrame:
    """finish(repeats, bucket, mask or None) -> table of schema, for each bucket; one plan, started by the caller's action."""
    parts = parts_for(docs)
    r = repeats(parts)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    points = split_points(rows.select("doc_id").na.drop(), "doc_id", 2 * parts)
    text = rows.withColumn("bucket", part_of(F.col("doc_id"), points)).repartition(parts, "bucket")

    def last(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return finish(r, Bucket(table), None).slice(0, 0)
        bucket = Bucket(table)
        return finish(r, bucket, r.removed(bucket, answers))

    own = text.groupBy("bucket")
    asked = own.applyInArrow(lambda key, t: r.send(key, t), SENT)
    coded = asked.groupBy("dest").applyInArrow(lambda key, t: r.answer(key, t), ANSWER)
    still = own.cogroup(coded.groupBy("bucket")).applyInArrow(lambda key, t, x: r.open(key, t, x), SENT)
    bits = still.groupBy("dest").applyInArrow(lambda key, t: r.settle(key, t), ANSWER)
    return own.cogroup(bits.groupBy("bucket")).applyInArrow(last, schema)
