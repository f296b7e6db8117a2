"""Similarity join of documents on 5-word shingles (Jaccard 0.8 or more) by chosen paths.

Documents with equal shingle sets are one class; only classes take part. A class has a sketch: the least token of each
of 128 bins. In each of ``RUNS`` runs a set picks sketched tokens by a hash that the run seeds, so two similar sets are
likely to pick a token that they share; tokens that very many sets hold are left to the sets that hold little else (see
thresholds). Sets that picked the same token form a node. Nodes of up to ``SMALL`` sets are compared by brute force on
sketches (a pair at the limit passes but for about one in 1e5). Larger nodes whose sets mostly hold the same
tokens (judged on a sample) are kept as a whole; all others are split again in the same way, with a hash seeded by the
path so far, down to ``DEPTH`` levels. The number of runs follows from the target recall, for pairs at the limit in nodes
that are split at every level. The first runs connect large groups, and in all later ones a node whose sets are connected
already is skipped. What passes is joined to components by label propagation over nodes, and the links of every
component are counted exactly (see verified_links): no group is gathered in one task, and no pair is emitted.

Result of join(): doc_id, class_id (least doc_id of the connected component of links), copy_id (least doc_id with an
equal set), n_links (documents linked to this one, copies included), n_class_links (linked classes with another set).
Defined results: texts under five words are one shingle; texts without words (null, empty) have equal, empty sets and
are one class; a null doc_id is the largest; equal rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwright.llm._shared import documents, written
from boxwright.llm._text import U64, chunks, hashes, mix, rolling, utf8, words

K, LIMIT, RECALL = 5, 0.8, 0.9999
SMALL, DEPTH, BLOCK, BINS, PASS, DENSE = 128, 6, 1024, 128, 0.64, 0.5
#: Runs of the first phase, which connect large groups; members whose tokens elect the centre of a group, on average;
#: share of a sketch's places that must differ from what its node agrees on, for a set to be split by these alone; how far
#: below LIMIT the share of common places in two sketches is taken to be, as it varies.
FIRST, ELECTORS, APART, MARGIN = 9, 32, 0.6, 0.07
#: A large node is judged by a hash sample of its members: one in COARSE, and of those about JUDGES at most.
COARSE, JUDGES = 16, 64
_STEP = 0x9E3779B97F4A7C15
#: Sets of a part in which tokens that may be common are looked for.
EMPTY, COMMON, PART = 0xFFFFFFFF, 4096, 16384


def missed(runs: int, levels: int, limit: float = LIMIT) -> float:
    """Chance that a pair at the limit meets in none of the runs, where its nodes are split down to the given level.

    A node of both has Poisson many common children; the chance that a common path survives follows level by level. All
    picks are from the sketches, whose common places are binomial and the same in every run, so the mean is over their
    number; at worst only the share APART of the places is picked from, and all places that are not common are among
    them (see thresholds).
    """
    total = 0.0
    for same in range(BINS + 1):
        mean = 2 / (1 + limit) * max(0.0, same - (1 - APART) * BINS) / ((limit - MARGIN - 1 + APART) * BINS)
        alive = 1.0
        for _ in range(levels - 1):
            alive = 1 - math.exp(-mean * alive)
        total += math.comb(BINS, same) * limit**same * (1 - limit) ** (BINS - same) * math.exp(-mean * alive) ** runs
    return total


def runs_for(recall: float, levels: int, limit: float = LIMIT) -> int:
    """Least number of runs that misses no larger share of the pairs at the limit than the target allows."""
    runs = 1
    while missed(runs, levels, limit) > 1 - recall:
        runs += 1
    return runs


RUNS = runs_for(RECALL, DEPTH)


def shingle_sets(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each text, and their offsets."""
    s, e, doc = words(buf, offs)
    h = hashes(buf, s, e)
    n = len(offs) - 1
    count = np.bincount(doc, minlength=n)
    win = rolling(h, K)
    at = np.flatnonzero(doc[: len(win)] == doc[K - 1 :][: len(win)]) if len(win) else np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < K))
    first = np.cumsum(count) - count
    token = np.concatenate([mix(win[at]), *(mix(rolling(h[first[d] : first[d] + count[d]], int(count[d])) + U64(count[d])) for d in short)])
    owner = np.concatenate([doc[at], short]).astype(np.int64)
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[new], owner[new]
    return token, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def fingerprints(token: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Two 64-bit values of each set."""
    total = np.concatenate([np.zeros((2, 1), U64), np.cumsum(np.stack([mix(token + U64(1)), mix(token ^ U64(_STEP))]), axis=1, dtype=U64)], axis=1)
    return mix(total[:, offs[1:]] - total[:, offs[:-1]] + np.diff(offs).astype(U64)).T


def sketches(token: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per set 32 bits of the least hash in each of BINS bins of its tokens; EMPTY: none."""
    h = mix(token ^ U64(0x632BE59BD9B4E019))
    key = (owner.astype(U64) * U64(BINS) + h % U64(BINS)) << U64(36) | h >> U64(28)
    key.sort()
    slot = key >> U64(36)
    first = np.ones(len(key), bool)
    first[1:] = slot[1:] != slot[:-1]
    out = np.full(n * BINS, EMPTY, "<u4")
    out[slot[first].astype(np.int64)] = np.minimum(mix(key[first] & U64((1 << 36) - 1)) >> U64(32), U64(EMPTY - 1))
    return out.reshape(n, BINS)


def places(value: np.ndarray) -> np.ndarray:
    """The tokens that sketches stand for: place and value."""
    return np.arange(BINS, dtype=U64) << U64(32) | value.astype(U64)


def thresholds(held: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Chance with which each place of a sketch is picked; ``apart`` are the places that tell sets from others.

    Tokens that very many sets hold (a passage, a template) split nothing. So where APART of a sketch's places or more
    are apart, it picks from these alone, and a set near that share from both kinds: two sets at the limit differ in
    1 - LIMIT of all places (MARGIN more are allowed for), so they still share enough of those, and the rate rises
    accordingly. So that pairs of the worst sizes meet as often, 2 / (1 + LIMIT) times as many are picked.
    """
    total, own = np.maximum(held.sum(1), 1), apart.sum(1)
    rate = 2 / (1 + LIMIT) / np.maximum((LIMIT - MARGIN) * total, 1.3)
    high = 2 / (1 + LIMIT) / np.maximum(own - (1 - LIMIT + MARGIN) * total, 1.3)
    alone, both = own >= APART * total, own >= (APART - 1.6 * (1 - LIMIT)) * total
    every, some = np.where(alone, 0.0, rate)[:, None], np.where(both, high, 0.0)[:, None]
    return np.maximum(np.where(held, every, 0.0), np.where(apart, some, 0.0))


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketches, along the last axis; two empty ones are equal."""
    any_, same = (np.minimum(a, b) != EMPTY), a == b
    n = any_.sum(-1)
    return np.where(n > 0, (any_ & same).sum(-1) / np.maximum(n, 1), 1.0)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        for a, b in chunks(offs):
            token, own = shingle_sets(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            sizes = np.diff(own)
            owner = np.repeat(np.arange(b - a), sizes)
            fp, sketch = (pa.array([x.tobytes() for x in y], pa.binary()) for y in (fingerprints(token, own), sketches(token, owner, b - a)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("th").slice(a, b - a), fp, sketch], ["doc_id", "th", "fp", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        for a, b in chunks(offs):
            token, own = shingle_sets(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            fps = [x.tobytes() for x in fingerprints(token, own)]
            sets = [token[own[i] : own[i + 1]].tobytes() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("label", "size", "n")), pa.array(fps, pa.binary()), pa.array(sets, pa.binary())], ["label", "size", "n", "fp", "tokens"])


def _frequent(least: float, total: int, dests: int):
    """Tokens that reach their part's share of ``least``, of parts of up to PART sets: what ``least`` of ``total`` sets hold is among them."""

    def row(values: list[np.ndarray]) -> pa.RecordBatch:
        value = np.concatenate(values)
        token, n = np.unique(places(value)[value != EMPTY], return_counts=True)
        token = token[n * total >= least * len(value)]
        to = (mix(token) % U64(dests)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.unique(to), pa.int32()), pa.array([token[to == d].tobytes() for d in np.unique(to)], pa.binary())], ["dest", "token"])

    return lambda batches: (row(values) for values in _parts(batches))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Sketches as matrices, in lists of PART sets or more; a task's last list may hold fewer."""
    values, size = [], 0
    for batch in batches:
        for a in range(0, len(batch), PART):
            values.append(np.frombuffer(b"".join(batch.column("sketch").slice(a, PART).to_pylist()), "<u4").reshape(-1, BINS))
            size += len(values[-1])
            if size >= PART:
                yield values
                values, size = [], 0
    if size:
        yield values


def _counts(tokens, dests: int):
    """Packed counts of the given tokens (sorted) over all sets, dealt by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = tokens.value
        n = np.zeros(len(every), np.int64)
        for values in _parts(batches):
            for value in values:
                token = places(value)[value != EMPTY]
                at = np.minimum(np.searchsorted(every, token), len(every) - 1)
                n += np.bincount(at[every[at] == token], minlength=len(every))
        seen = np.flatnonzero(n)
        to = (mix(every[seen]) % U64(dests)).astype(np.int64)
        rows = [(d, every[seen[to == d]].tobytes(), n[seen[to == d]].astype("<u8").tobytes()) for d in np.unique(to).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 3, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["dest", "token", "n"])

    return run


def common_places(classes: DataFrame, dests: int = 64) -> np.ndarray:
    """Tokens of sketches that more than SMALL sets, and one in COMMON of all, hold; counted on every set.

    At most BINS x COMMON tokens, whatever the number of sets. A token that reaches the limit over all sets reaches its
    share of the limit in one part of them at least; so the tokens that do so are gathered first, and counted in all sets then.
    """
    total = classes.count()
    least = max(SMALL, total / COMMON)

    def merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        token = np.unique(np.frombuffer(b"".join(table.column("token").to_pylist()), "<u8"))
        return pa.table({"token": pa.array([token.tobytes()], pa.binary())})

    def summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        token, n = (np.concatenate([np.frombuffer(x, "<u8") for x in table.column(c).to_pylist()]) for c in ("token", "n"))
        token, place = np.unique(token, return_inverse=True)
        return pa.table({"token": pa.array([token[np.bincount(place, n) > least].tobytes()], pa.binary())})

    def gathered(rows: DataFrame, f) -> np.ndarray:
        return np.sort(np.frombuffer(b"".join(r.token for r in rows.groupBy("dest").applyInArrow(f, "token binary").collect()), "<u8"))

    sketch = classes.select("sketch")
    likely = gathered(sketch.mapInArrow(_frequent(least, total, dests), "dest int, token binary"), merged)
    if not len(likely):
        return likely
    told = classes.sparkSession.sparkContext.broadcast(likely)
    return gathered(sketch.mapInArrow(_counts(told, dests), "dest int, token binary, n binary"), summed)


def _first(common, runs: range):
    """Nodes of each set in the given runs, picked from its sketch; a hash of 64 bits serves four runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u4").reshape(len(batch), BINS)
            token, held = places(value), value != EMPTY
            apart = held
            if len(common.value):
                at = np.minimum(np.searchsorted(common.value, token), len(common.value) - 1)
                apart = held & (common.value[at] != token)
            row, place = np.nonzero(held)
            below = np.ceil(65536 * np.minimum(thresholds(held, apart)[row, place], 1.0)).astype(np.uint32)[:, None]
            own, rows, keys = token[row, place], [], []
            for g in range(runs.start // 4, -(-runs.stop // 4)):
                at, lane = np.nonzero(mix(own ^ mix(np.array([g + 1], U64))).view("<u2").reshape(-1, 4) < below)
                r = 4 * g + lane
                inside = (r >= runs.start) & (r < runs.stop)
                rows.append(row[at[inside]])
                keys.append(mix(mix(own[at[inside]]) + (r[inside].astype(U64) + U64(1)) * U64(_STEP)))
            taken = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), *(batch.column(c).take(taken) for c in ("fp", "label"))], ["key", "fp", "label"])

    return run


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Next level of the node of each set, picked from its sketch: apart are the places on which the node does not agree."""
    for batch in batches:
        n = len(batch)
        node = batch.column("key").to_numpy().view(U64)
        value, agreed = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(n, BINS) for c in ("sketch", "agreed"))
        held = value != EMPTY
        h = mix(mix(places(value)) ^ mix(node)[:, None])
        row, at = np.nonzero(h.astype(np.float64) / 2.0**64 < thresholds(held, held & (value != agreed)))
        rows = pa.array(row)
        yield pa.RecordBatch.from_arrays([pa.array(mix(h[row, at] + U64(_STEP)).view(np.int64)), *(batch.column(c).take(rows) for c in ("fp", "label", "sketch"))], ["key", "fp", "label", "sketch"])


def _judged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of each node in the unit: the values that most judges hold, and which share of a judge's places agree with them."""
    table = table.sort_by([("key", "ascending"), ("fp", "ascending")])
    node = table.column("key").to_numpy()
    value = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u4").reshape(len(node), BINS)
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, int)
    alike, agreed = [], []
    for x, y in zip(first, np.append(first[1:], len(node)), strict=True):
        mine = value[x:y]
        middle = np.sort(mine, axis=0)[(y - x) // 2]  # a value that more than half hold is the median
        same = (mine == middle) & (middle != EMPTY)
        most = 2 * same.sum(0) > y - x
        alike.append(float(((same & most).sum(1) / np.maximum((mine != EMPTY).sum(1), 1)).mean()))
        agreed.append(np.where(most, middle, EMPTY).astype("<u4").tobytes())
    return pa.table({"key": node[first], "alike": pa.array(alike, pa.float64()), "agreed": pa.array(agreed, pa.binary())})


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component, by propagating labels along the links a - b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _filter(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Stars (root, member) of the pairs in each node that the sketches let pass."""
    table = table.sort_by([("key", "ascending"), ("fp", "ascending")])  # a star's root is its least member
    node = table.column("key").to_numpy()
    order = np.arange(len(node))
    fps = table.column("fp").to_pylist()
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u4").reshape(len(fps), BINS)
    out_a, out_b = [], []
    edge = np.flatnonzero(np.diff(node[order], prepend=node[order[0]] - 1 if len(order) else 0, append=0) != 0) if len(order) else np.zeros(0, int)
    cuts = np.append(np.unique(edge[edge < len(order)]), len(order)) if len(order) else edge
    for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        at = order[x:y]
        s = sketch[at]
        near = [np.flatnonzero(similarity(s[i + 1 :], s[i]) >= PASS) + i + 1 for i in range(len(at) - 1)]
        a = np.repeat(np.arange(len(at) - 1), [len(v) for v in near])
        b = np.concatenate(near) if near else a
        label = roots(len(at), a, b)
        for i in np.flatnonzero(label != np.arange(len(at))):
            out_a.append(fps[at[label[i]]])
            out_b.append(fps[at[i]])
    return pa.table({"hub": pa.array(out_a, pa.binary()), "fp": pa.array(out_b, pa.binary())})


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 matrices over the tokens that both sides hold."""
    sizes = [len(x) for x in left]
    token, place = np.unique(np.concatenate([*left, *right]) if left or right else np.zeros(0, U64), return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [*sizes, *(len(x) for x in right)])
    lefts = np.zeros(len(token), bool)
    lefts[place[: sum(sizes)]] = True
    both = np.zeros(len(token), bool)
    both[place[sum(sizes) :]] = True
    both &= lefts
    column = np.cumsum(both) - 1
    keep = both[place]
    row, place = row[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, int(both.sum()), width):
        x, y = np.searchsorted(place, [c, c + width])
        m = np.zeros((len(left) + len(right), width), np.float32)
        m[row[x:y], place[x:y] - c] = 1
        total += m[: len(left)] @ m[len(left) :].T
    return total


def _center(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The tokens that more than half of the electors hold; any set would do, a near one leaves little to compare."""
    sets = [np.frombuffer(x, U64) for x in table.column("tokens").to_pylist()]
    token, n = np.unique(np.concatenate(sets), return_counts=True)
    return pa.table({"label": pa.array([key[0].as_py()], pa.binary()), "center": pa.array([token[2 * n > len(sets)].tobytes()], pa.binary())})


DIFFS = "label binary, fp binary, n long, base long, gone long, extra long, tokens binary"


def _diffs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set as what it lacks (gone) and has beyond (extra) its group's centre of base tokens."""
    for batch in batches:
        made = []
        for tokens, center in zip(batch.column("tokens").to_pylist(), batch.column("center").to_pylist(), strict=True):
            x, c = np.frombuffer(tokens, U64), np.frombuffer(center or b"", U64)
            minus, plus = np.setdiff1d(c, x, assume_unique=True), np.setdiff1d(x, c, assume_unique=True)
            made.append((len(c), len(minus), len(plus), np.concatenate([minus, plus]).tobytes()))
        cols = list(zip(*made, strict=True)) if made else [[]] * 4
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "fp", "n")), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], [x.split()[0] for x in DIFFS.split(", ")])


def _links(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of a and b tokens that share so many are similar."""
    return shared * (1 + LIMIT) >= LIMIT * (a + b) - 1e-6


SETTLED = "label binary, gone long, extra long, classes long, docs long, own boolean, root binary, first int, blocks int, partners array<int>"


def _settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """What sizes alone decide in one group; a row of table is a kind: the sets with equal (gone, extra).

    Two sets share at least base - gone - gone' tokens and at most base - max(gone, gone') + min(extra, extra'). The
    least is enough exactly if weight + weight' <= (1 - LIMIT) x base, with weight = gone + LIMIT x extra: so links of
    this sort are counted by a prefix sum over ascending weights, and all that have any are linked to the lightest set.
    Kinds are dealt to blocks of about BLOCK sets by weight; partners are the blocks with an open pair of kinds, where
    the least is not enough and the most is.
    """
    table = table.sort_by([("gone", "ascending"), ("extra", "ascending")])
    gone, extra, kinds, docs = (np.asarray(table.column(c)) for c in ("gone", "extra", "kinds", "docs"))
    base, heads = int(table.column("base")[0].as_py()), table.column("head").to_pylist()
    weight = gone + LIMIT * extra
    order = np.argsort(weight, kind="stable")
    room = (1 - LIMIT) * base + 1e-6
    upto = np.searchsorted(weight[order], room - weight, "right")
    n_kinds, n_docs = (np.concatenate([[0], np.cumsum(x[order])]) for x in (kinds, docs))
    own = 2 * weight <= room
    light = order[0]
    joined = weight + weight[light] <= room
    root = [heads[light] if j else None for j in joined]
    # blocks: light kinds share one, a kind of more than BLOCK sets has some of its own
    first, blocks = np.zeros(len(order), np.int64), np.ones(len(order), np.int64)
    at, filled = -1, BLOCK
    for k in order.tolist():
        blocks[k] = -(-int(kinds[k]) // BLOCK)
        if blocks[k] > 1 or filled + kinds[k] > BLOCK:
            at, filled = at + 1, 0
        first[k] = at
        at += int(blocks[k]) - 1
        filled = BLOCK if blocks[k] > 1 else filled + int(kinds[k])
    size = base - gone + extra
    partners: list[set] = [set() for _ in order]
    for k in range(len(order)):
        most = base - np.maximum(gone[k], gone) + np.minimum(extra[k], extra)
        open_ = _links(most, size[k], size) & (weight[k] + weight > room)
        open_[k] &= kinds[k] > 1
        for j in np.flatnonzero(open_).tolist():
            partners[k].update(range(int(first[j]), int(first[j] + blocks[j])))
    return pa.table({
        "label": pa.array([key[0].as_py()] * len(order), pa.binary()), "gone": gone, "extra": extra, "classes": n_kinds[upto], "docs": n_docs[upto], "own": own,
        "root": pa.array(root, pa.binary()), "first": pa.array(first, pa.int32()), "blocks": pa.array(blocks, pa.int32()), "partners": pa.array([sorted(p) for p in partners], pa.list_(pa.int32())),
    })


def _verify(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Exact links, but for those that sizes settle, of the block pairs in one unit of work: per set its linked classes
    and documents, and a star's root."""
    out: tuple[list, ...] = ([], [], [], [])
    groups: dict = {}
    for r in table.to_pylist():
        groups.setdefault((r["comp"], r["bi"], r["bj"]), []).append(r)
    for (_, bi, bj), members in groups.items():
        members = sorted({r["fp"]: r for r in members}.values(), key=lambda r: r["fp"])  # a set once, though its row repeats
        lefts = [r for r in members if r["block"] == bi]
        rights = lefts if bi == bj else [r for r in members if r["block"] == bj]
        if not rights or not lefts:
            continue
        sets = [[np.frombuffer(r["tokens"], U64) for r in side] for side in ((lefts,) if bi == bj else (lefts, rights))]
        base = lefts[0]["base"]
        gone, extra = ([np.array([r[c] for r in side], np.float64) for side in (lefts, rights)] for c in ("gone", "extra"))
        # tokens of the centre are only in lists of what is gone, all others only in lists of what is extra
        least = base - gone[0][:, None] - gone[1][None, :]
        weight = [g + LIMIT * e for g, e in zip(gone, extra, strict=True)]
        linked = _links(least + shared_counts(sets[0], sets[-1]), (base - gone[0] + extra[0])[:, None], (base - gone[1] + extra[1])[None, :])
        linked &= weight[0][:, None] + weight[1][None, :] > (1 - LIMIT) * base + 1e-6
        if bi == bj:
            np.fill_diagonal(linked, False)
        a, b = np.nonzero(linked)
        every = lefts if bi == bj else lefts + rights
        label = roots(len(every), a, b if bi == bj else b + len(lefts))
        least = [min(every[label[i]]["fp"], r["fp"]) for i, r in enumerate(every)]
        for i, f in enumerate(least):  # across two blocks the least number need not be the least member
            least[label[i]] = min(least[label[i]], f)
        weights = [np.array([r["n"] for r in side]) for side in (lefts, rights)]
        for side, m, w in [(lefts, linked, weights[1])] + ([] if bi == bj else [(rights, linked.T, weights[0])]):
            for r, c, d in zip(side, m.sum(1).tolist(), (m @ w).tolist(), strict=True):
                out[0].append(r["fp"])
                out[1].append(c)
                out[2].append(d)
        for c, side in enumerate((lefts,) if bi == bj else (lefts, rights)):
            out[3].extend(least[label[i + (len(lefts) if c else 0)]] for i in range(len(side)))
    return pa.table({"fp": pa.array(out[0], pa.binary()), "classes": pa.array(out[1], pa.int64()), "docs": pa.array(out[2], pa.int64()), "root": pa.array(out[3], pa.binary())})


def components(edges: DataFrame) -> DataFrame:
    """fp, label of the graph of (hub, fp) rows, both binary: the least hub reached.

    A member keeps its least hub, to which its other hubs are linked; so only the graph of hubs is left, which is small
    as every star's hub is its least member. There, each round passes the least label along the links and jumps to the
    label's label, until nothing changes; labels are written tables.
    """
    every = edges.select("hub", "fp").unionByName(edges.select("hub", F.col("hub").alias("fp"))).distinct()
    every = written(every, "edges")
    low = written(every.groupBy("fp").agg(F.min("hub").alias("low")), "low")
    links = written(every.join(low, "fp").where(F.col("hub") != F.col("low")).select(F.col("low").alias("a"), F.col("hub").alias("b")).distinct(), "links")
    if links.isEmpty():
        return low.select("fp", F.col("low").alias("label"))
    links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label"), F.lit(True).alias("moved"))
    label = written(label, "label")
    while True:
        near = links.join(label.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = F.least("label", "near", F.coalesce("far", "label"))
        label = written(label.select("node", "label").join(near, "node").join(jump, "label", "left").select("node", new.alias("label"), (new != F.col("label")).alias("moved")), "label")
        if label.where("moved").isEmpty():
            break
    named = label.select(F.col("node").alias("low"), "label")
    return low.join(named, "low", "left").select("fp", F.coalesce("label", "low").alias("label"))


def candidates(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Stars (hub, fp) of the sets that meet, from nodes of key, fp and label; nodes of one label only add nothing."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stars, sketched = None, classes.select("fp", "sketch")
    for depth in range(1, DEPTH + 1):
        sizes = nodes.groupBy("key").agg(F.count("*").alias("size"), F.min("fp").alias("hub"), F.min("label").alias("low"), F.max("label").alias("high"))
        sizes = written(sizes.where("size > 1 AND low <> high").drop("low", "high"), "sizes")
        met = nodes.join(sizes, "key")
        if depth == 1:  # sketches come after the nodes of one set are gone; deeper nodes bring theirs along
            met = met.join(sketched, "fp")
        met = written(met, "met")
        unit = F.pmod(F.xxhash64("key"), F.lit(4 * parts)).alias("unit")
        small = met.where(F.col("size") <= SMALL).select("key", "fp", "sketch").groupBy(unit).applyInArrow(_filter, "hub binary, fp binary")
        stars = small if stars is None else stars.unionByName(small)
        heads = sizes.where(F.col("size") > SMALL)
        if heads.isEmpty():
            break
        # a bounded sample of its members judges a node
        turn = F.pmod(F.xxhash64("fp", "key"), F.lit(1 << 30))
        some = met.where((F.col("size") > SMALL) & (turn % COARSE == 0))
        some = some.where(F.floor(turn / COARSE) % F.ceil(F.col("size") / F.lit(COARSE * JUDGES)) == 0)
        judged = some.select("key", "fp", "sketch").groupBy(unit).applyInArrow(_judged, "key long, alike double, agreed binary")
        none = F.struct(F.lit(0.0).alias("alike"), F.lit(b"\xff" * (4 * BINS)).alias("agreed"))  # no judge by chance: split by all
        marks = heads.select("key").join(judged.select("key", F.struct("alike", "agreed").alias("j")), "key", "left").select("key", F.coalesce("j", none).alias("j")).select("key", "j.*")
        marks = written(marks, "marks")
        marked = met.where(F.col("size") > SMALL).join(marks, "key")
        whole = (F.col("alike") >= DENSE) | F.lit(depth == DEPTH)
        stars = stars.unionByName(marked.where(whole).select("hub", "fp"))
        if depth == DEPTH:
            break
        split = marked.where(~whole).select("key", "fp", "label", "sketch", "agreed")
        nodes = written(split.mapInArrow(_children, "key long, fp binary, label binary, sketch binary"), "nodes")
        if nodes.isEmpty():
            break
    return stars


def verified_links(member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, classes, docs) to be summed, and the links' stars (hub, fp), of rows of label, size, fp, n and tokens.

    Groups of up to BLOCK sets are compared by brute force. In larger ones each set is told by its difference from the
    group's centre: sizes settle most pairs in bulk (see _settle), and only blocks with open pairs are compared, by the
    differences. Any centre gives the same result, so its electors may be few.
    """
    parts = int(member.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = member.where(F.col("size") <= BLOCK).select(F.col("label").alias("comp"), "fp", "n", "tokens", *(F.lit(0).cast("long").alias(c) for c in ("base", "gone")), (F.octet_length("tokens") / 8).cast("long").alias("extra"), *(F.lit(0).alias(c) for c in ("block", "bi", "bj")))
    work = whole.withColumn("unit", F.pmod(F.xxhash64("comp"), F.lit(8 * parts)))
    large = member.where(F.col("size") > BLOCK).dropDuplicates(["fp"])  # equal rows of docs give equal sets
    bulk = None
    if not large.isEmpty():
        voters = large.where(F.pmod(F.xxhash64("fp"), F.ceil(F.col("size") / F.lit(ELECTORS))) == 0)
        centers = written(voters.select("label", "tokens").groupBy("label").applyInArrow(_center, "label binary, center binary"), "centers")
        diffs = written(large.join(centers, "label", "left").select("label", "fp", "n", "tokens", "center").mapInArrow(_diffs, DIFFS), "diffs")
        kinds = diffs.groupBy("label", "gone", "extra").agg(F.count("*").alias("kinds"), F.sum("n").alias("docs"), F.min("fp").alias("head"), F.min("base").alias("base"))
        settled = written(kinds.groupBy("label").applyInArrow(_settle, SETTLED), "settled")
        told = written(diffs.drop("tokens").join(settled, ["label", "gone", "extra"]), "told")
        own = F.col("own").cast("long")
        bulk = told.where("root IS NOT NULL").select("fp", (F.col("classes") - own).alias("classes"), (F.col("docs") - own * F.col("n")).alias("docs"), "root")
        block = (F.col("first") + F.pmod(F.xxhash64("fp"), F.col("blocks"))).cast("int")
        pairs = told.where(F.size("partners") > 0).select("fp", block.alias("block"), F.explode("partners").alias("other"))
        open_ = diffs.join(pairs, "fp").select(F.col("label").alias("comp"), "fp", "n", "tokens", "base", "gone", "extra", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
        work = work.unionByName(open_.withColumn("unit", F.xxhash64("comp", "bi", "bj")))
    every = written(work.groupBy("unit").applyInArrow(_verify, "fp binary, classes long, docs long, root binary"), "verified")
    every = every if bulk is None else every.unionByName(bulk)
    return every.select("fp", "classes", "docs"), every.select(F.col("root").alias("hub"), "fp")


NODES = "key long, fp binary, label binary"


def join(docs: DataFrame) -> DataFrame:
    """See the module; also th, the text's hash, which tells rows with equal doc_id apart."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    signed = written(text.mapInArrow(_sign, "doc_id long, th long, fp binary, sketch binary"), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))
    classes = written(signed.groupBy("fp").agg(least.alias("rep"), F.count("*").alias("n"), F.min("sketch").alias("sketch")), "classes")

    # the first runs connect large groups; what lies in one group already need not meet again
    common = docs.sparkSession.sparkContext.broadcast(common_places(classes))
    named = classes.select("fp", "sketch", F.col("fp").alias("label"))
    stars = candidates(named.mapInArrow(_first(common, range(FIRST)), NODES), classes)
    comps = written(components(stars), "comps")
    named = classes.select("fp", "sketch").join(comps, "fp", "left").select("fp", "sketch", F.coalesce("label", "fp").alias("label"))
    stars = candidates(named.mapInArrow(_first(common, range(FIRST, RUNS)), NODES), classes).unionByName(comps.select(F.col("label").alias("hub"), "fp"))
    comps = written(components(stars), "comps")

    sizes = comps.groupBy("label").agg(F.count("*").alias("size")).where("size > 1")
    wanted = comps.join(sizes, "label").join(classes.select("fp", "rep", "n"), "fp").select("label", "size", F.col("n"), F.col("rep.doc_id").alias("__d"), F.col("rep.th").alias("__t"))
    chosen = text.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("th") == F.col("__t")))
    member = written(chosen.select("label", "size", "n", "text").mapInArrow(_sets, "label binary, size long, n long, fp binary, tokens binary"), "members")
    counts, stars = verified_links(member)
    group = written(components(stars), "groups")
    links = counts.groupBy("fp").agg(F.sum("classes").alias("classes"), F.sum("docs").alias("docs"))

    joined = classes.select("fp", "rep", "n").join(links, "fp", "left").join(group, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    head = joined.groupBy("label").agg(F.min("rep").alias("head"))
    named = joined.join(head, "label").select("fp", F.col("head.doc_id").alias("class_id"), F.col("head.th").alias("class_th"), F.col("rep.doc_id").alias("copy_id"), (F.col("n") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"), F.coalesce("classes", F.lit(0)).alias("n_class_links"))
    return signed.select("doc_id", "th", "fp").join(named, "fp").drop("fp")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir)).drop("th", "class_th")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each connected component stays, that of the least doc_id; all columns, whatever their names."""
    found = join(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("th") == F.col("class_th"))).select("doc_id", "th")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kept = rows.join(found.select(F.col("doc_id").alias("kept_id"), F.col("th").alias("kept_th")), F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("th") == F.col("kept_th")), "left_semi")
    return kept.dropDuplicates(["doc_id", "th"]).select("row.*")
