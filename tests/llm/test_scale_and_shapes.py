"""Odd rows, clashing names, partitionings, blocks and groups of the training-data operators."""

import random
import struct

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxwright.llm import _crc32c, op1_scoring, op2_records, op3_packing, op5_pii, op6_outliers, op7_chosen_path, op8_suffixes, op9_recompression, op10_decontaminate
from boxwright.llm._repeats import Bucket

RNG = random.Random(11)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randrange(3, 9))) for _ in range(3000)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def repeated_ids():
    """Rows that share a doc_id, whole rows twice, null ids, and passages across them."""
    a, b = prose(80), prose(60)
    return [(1, a), (1, a + " " + b), (1, a), (2, b + " tail"), (2, None), (3, a), (3, a), (None, a), (None, b), (4, " ".join([b] * 3)), (5, "é" * 120), (5, "é" * 119)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def test_repeated_doc_ids(spark, repeated_ids):
    df = frame(spark, repeated_ids)
    got = [tuple(r) for r in op8_suffixes.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()]
    assert sorted_rows(got) == sorted_rows(brute.op8(repeated_ids))
    got = [tuple(r) for r in op9_recompression.remove_repeats(df).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256)).collect()]
    assert sorted_rows(got) == sorted_rows(brute.op9(brute.order(repeated_ids)))
    got = [(r.doc_id, r.n_words) for r in op6_outliers.judge(df.withColumns({"lang": F.lit("en"), "source": F.lit(None)})).collect()]
    assert sorted_rows(got) == sorted_rows([(d, brute.op6(t)[0]) for d, t in repeated_ids])
    got = [tuple(r)[:6] for r in op5_pii.find_pii(df).collect()]
    assert sorted_rows(got) == sorted_rows([(d, *brute.op5(t)[0]) for d, t in repeated_ids])
    links = op7_chosen_path.join(df).collect()
    assert len(links) == len(repeated_ids) and {(r.doc_id, r.n_links) for r in links if r.copy_id == 1 and r.n_class_links == 0} >= {(1, 4), (3, 4), (None, 4)}
    scores = op1_scoring.score(df).collect()
    assert len(scores) == len(repeated_ids) and len({(r.doc_id, r.n_words, r.log_prob) for r in scores}) == len(set(repeated_ids))
    import public_tokenizers

    pieces = op3_packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sum(r.start == 0 for r in pieces) == len(repeated_ids)


def test_one_plan_a_partitioning_scores_alike(spark, sf_dir):
    """The same scores from one partition and from eight."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one, eight = ({r.doc_id: r.log_prob for r in op1_scoring.score(x).collect()} for x in (df.coalesce(1), df.repartition(8)))
    assert one.keys() == eight.keys() and all(abs(one[k] - eight[k]) <= 1e-6 * max(1.0, abs(one[k])) for k in one)


def test_groups_share_the_training(spark, monkeypatch):
    """Many groups and slices, documents longer than a slice: all words take part."""
    monkeypatch.setattr(op1_scoring, "GROUP_WORDS", 3000)
    seen = []
    rows = [(i, " ".join(f"a{k % 7} b{k % 5}" for k in range(i, i + 400))) for i in range(40)] + [(99, None), (98, "")]
    df = frame(spark, rows)
    top = op1_scoring.vocabulary(df.select("text"))
    assert len(top) == 12 and not seen
    model = op1_scoring.train(df, top)
    word = op1_scoring.classes(np.concatenate([h for _, _, h, _ in op1_scoring._word_hashes(pa.array([rows[3][1]]))]), top)
    uniform = -np.log(12)
    assert op1_scoring.log_probs(model, word, np.zeros(len(word), int)).mean() > uniform + 0.5


def test_checksums_are_castagnoli():
    assert _crc32c.crc32c([b"123456789"])[0] == 0xE3069283 and _crc32c.crc32c([b""])[0] == 0
    assert _crc32c.crc32c([b"\0" * 32])[0] == 0x8A9136AA  # of the iSCSI standard

    def plain(data):
        c = 0xFFFFFFFF
        for x in data:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ _crc32c.POLY if c & 1 else c >> 1
        return c ^ 0xFFFFFFFF

    rng = np.random.default_rng(0)
    many = [rng.bytes(int(n)) for n in (1, 511, 512, 513, 1024, 1025, 3000, 0, 7)]
    assert _crc32c.crc32c(many).tolist() == [plain(x) for x in many]
    raw = op2_records.frame(b"abc")  # length, its masked checksum, data, its masked checksum
    assert struct.unpack("<Q", raw[:8])[0] == 3 and len(raw) == 8 + 4 + 3 + 4


def test_a_second_attempt_leaves_the_first_files_alone(spark, tmp_path):
    """Two writers of the same part (as a retry) write files of their own; each manifest names its own."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = frame(spark, [(i, f"text {i}") for i in range(20)], 1)
    folder = f"file://{tmp_path}/r"
    first = op2_records.write_records(df, folder, path)
    second = op2_records.write_records(df, folder, path)
    assert not {x[0] for x in first} & {x[0] for x in second}
    want = [(i, 0) for i in range(20)]
    for files in (first, second):
        assert [(r.doc_id, 0) for r in op2_records.read_records(spark, folder, files).orderBy("doc_id").collect()] == want


def test_blocks_of_a_million_item_words(spark, monkeypatch):
    """Items far beyond a block: one automaton a block and worker, and what one block would say."""
    rng = random.Random(5)
    items = [(k, " ".join(f"q{rng.randrange(200_000)}" for _ in range(n))) for k, n in enumerate([400_000, *[200] * 3200, 5, 10])]
    assert sum(t.count(" ") + 1 for _, t in items) > 1_000_000
    docs = [(0, "lead " + " ".join(items[0][1].split()[99_990:100_030]) + " end"), (1, items[7][1]), (2, "nothing here"), (3, None), (4, items[-2][1] + " x"), (5, " ".join(items[0][1].split()[:9])), (5, items[-1][1])]
    builds = []
    real = op10_decontaminate.Matcher.__init__
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    _, blocks = op10_decontaminate.item_blocks(bench, 10, 500_000)
    assert blocks == 3
    out = {(r.doc_id, r.n_words): (r.n_hit, r.n_items) for r in op10_decontaminate.scan(frame(spark, docs, 2), bench).collect()}
    assert out == {(0, 42): (40, 1), (1, 200): (200, 1), (2, 2): (0, 0), (3, 0): (0, 0), (4, 6): (5, 1), (5, 9): (0, 0), (5, 10): (10, 1)}
    # builds in one process: one for each block, however many batches there are
    monkeypatch.setattr(op10_decontaminate.Matcher, "__init__", lambda self, *a: builds.append(1) or real(self, *a))

    class Held:
        value = [(0, "1", "a b c")]

    batch = pa.RecordBatch.from_arrays([pa.array(["a b c"] * 50)], ["text"])
    for key in ("k1", "k2"):
        for _ in op10_decontaminate._scanner(key, Held, 10)(iter([batch] * 7)):
            pass
    assert len(builds) == 2


def test_large_groups_settle_by_size(spark, monkeypatch):
    """A group of 4,000 near copies: links are exact, and the rows that are compared do not grow with its square."""
    base = [f"w{k}" for k in range(150)]
    rng = random.Random(3)
    rows = []
    for i in range(4000):
        w = list(base)
        w[rng.randrange(150)] = f"own{i}"
        rows.append((i, " ".join(w)))
    seen = []
    real = op7_chosen_path.written
    monkeypatch.setattr(op7_chosen_path, "written", lambda df, name: seen.append((name, out := real(df, name))) or out)
    got = op7_chosen_path.join(frame(spark, rows, 4)).select("doc_id", "class_id", "n_links").collect()
    assert {r.class_id for r in got} == {0} and {r.n_links for r in got} == {3999}
    (verified,) = [df for name, df in seen if name == "verified"]
    assert verified.count() <= 2 * len(rows)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_uncertain_pairs_are_compared(spark, monkeypatch, edits):
    """Groups where sizes settle some pairs and the rest are compared in several blocks, against the plain index."""
    monkeypatch.setattr(op7_chosen_path, "BLOCK", 24)
    rng, base = random.Random(edits), [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(120)] = f"o{rng.randrange(40)}"
        rows.append((i, " ".join(w[: rng.choice([110, 120, 120])])))
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in op7_chosen_path.join(frame(spark, rows)).collect())
    assert got == brute.op7(rows)


def test_join_of_ten_thousand(spark):
    """Every document of the table of 10,000, against the plain index."""
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in op7_chosen_path.join(df).collect())
    want = brute.op7(rows)
    assert sum(a != b for a, b in zip(got, want, strict=True)) == 0


def test_places_of_a_bucket_are_checked():
    class Long(pa.Table):
        pass

    table = pa.table({"doc_id": pa.array([2, 1], pa.int64()), "text": pa.array(["b", "a"])})
    assert Bucket(table).buf.tobytes() == b"ab"


CLASH = ["__id", "__d", "__t", "__h", "row", "kept", "th", "label", "cuts", "n_words", "text_", "a.b", "Key"]


def test_stages_keep_columns_of_any_name(spark, sf_dir):
    import corpus_pipeline

    text = prose(120)
    rows = [(1, text), (2, text), (3, prose(90) + " mail a.b@example.org now"), (4, None), (None, prose(70)), (5, prose(80))]
    df = frame(spark, rows).withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"), **{c: F.lit(c) for c in CLASH}})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, sf_dir)
        assert out.columns == df.columns, name
        held = out.collect()
        assert held and all(r[c] == c for r in held for c in CLASH)
        empty = stage(spark, df.limit(0), sf_dir)
        assert empty.columns == df.columns and empty.count() == 0
    assert corpus_pipeline.pack(spark, df.limit(0), sf_dir).count() == 0
    packed = corpus_pipeline.pack(spark, df, sf_dir).collect()
    assert sum(r.start == 0 for r in packed) == len(rows) and all(len(r.ids) == 2 * r.length or len(r.ids) == 4 * r.length for r in packed)


def test_a_cluster_needs_a_shared_folder():
    from boxwright.llm import _shared

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="share"):
        _shared.shared_dir(Session(), "x")


def test_spans_of_new_kinds():
    text = "Please ask Dr. Jane Miller of 12 Old Mill Road about commit 04dbebab91ab85687d33eeaaf9ac699e1188f962 or token=04dbebab91ab85687d33eeaaf9ac699e1188f962 in 1999-2001"
    kinds = {k: text[a:b] for a, b, k in op5_pii.candidates(text)}
    assert kinds["person"] == "Dr. Jane Miller" and kinds["street"] == "12 Old Mill Road"
    votes = {(a, k): op5_pii.describe(text, a, b, k)[0] for a, b, k in op5_pii.candidates(text) if k == "secret"}
    (first, second) = (votes[k] for k in sorted(votes))
    assert first[1] == -1 and second[1:3] == (1, 1)  # a commit is announced as something else; a token is assigned
    assert all(len(op5_pii.describe(text, a, b, k)[1]) == op5_pii.FEATURES for a, b, k in op5_pii.candidates(text))
    a, b, k = next(c for c in op5_pii.candidates("see page 300 400 500 600") if c[2] == "number")
    assert op5_pii.describe("see page 300 400 500 600", a, b, k)[0][1] == -1


def test_added_spans_on_held_out_text():
    """Planted secrets and phone numbers among ordinary codes: the classifier, trained on other texts, tells them apart."""
    rng = random.Random(1)

    def sample(n):
        texts, marks = [], []
        for _ in range(n):
            secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            phone = f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
            plain = "".join(rng.choice("abcdefgh_") for _ in range(26))
            texts.append(f"set api_key = \"{secret}\" please call {phone} or see {plain}9 on page {rng.randrange(1000, 9999)} {rng.randrange(1000, 9999)}")
            marks.append({secret, phone})
        return texts, marks

    from types import SimpleNamespace

    train, _ = sample(300)
    batch = pa.RecordBatch.from_arrays([pa.array(train)], ["text"])
    rows = [SimpleNamespace(**r) for out in op5_pii._count(iter([batch])) for r in out.to_pylist()]
    weights, table = op5_pii.train(rows)
    held, marks = sample(100)
    found = [{t[a:b] for a, b, _ in op5_pii.find(t, weights)[1]} for t in held]
    hit = sum(len(f & m) for f, m in zip(found, marks, strict=True)) / sum(map(len, marks))
    extra = sum(len(f - m) for f, m in zip(found, marks, strict=True)) / sum(map(len, marks))
    assert hit > 0.95 and extra < 0.05
    assert (table[:, 1, 2] > table[:, 1, 0]).all()  # a vote for is likelier of a true span


def test_distances_against_a_plain_fit(spark, sf_dir):
    """The whole fit against numpy on the smallest table, with cells small enough to take part."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.lang, r.source, r.text) for r in docs.collect()]
    got = {r.doc_id: r.d2 for r in op6_outliers.judge(docs, min_cell=30).collect()}
    want = brute.op6_distances([r[1:] for r in rows], 30)
    for (d, *_), w in zip(rows, want, strict=True):
        assert (got[d] is None) == (w is None) and (w is None or abs(got[d] - w) <= 1e-6 * max(1.0, w))


def test_cutoff_is_fitted_to_labels(spark):
    rows = [(i, float(i)) for i in range(100)]
    judged = spark.createDataFrame([*rows, (200, None)], "doc_id long, d2 double")
    label = lambda at: spark.createDataFrame([(i, int(i < at)) for i, _ in rows if i not in range(60, 70)] + [(None, 1), (300, 0), (5, None)], "doc_id long, quality int")
    assert op6_outliers.fitted_cutoff(judged, label(65)) == pytest.approx((59 * 70) ** 0.5)
    assert op6_outliers.fitted_cutoff(judged, label(1000)) == op6_outliers.CUTOFF  # one class only
    assert op6_outliers.fitted_cutoff(judged, label(65).limit(0)) == op6_outliers.CUTOFF


def test_labelled_junk_goes(spark):
    """On the larger table every fair document that is labelled good stays, and all labelled junk goes."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = op6_outliers.judge(docs, labels=labels).where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    assert {r.quality: r.kept for r in rows} == {1: 1.0, 0: 0.0}


def test_pipeline_against_plain_stages(spark, tmp_path):
    """Ids, texts and pieces of every stage, with planted junk, copies, benchmark passages and personal data."""
    import corpus_pipeline
    import public_tokenizers
    from boxwright.llm import _tokens

    rng = random.Random(21)
    bench = [(k, prose(30, rng)) for k in range(5)] + [(5, "three short words"), (6, None)]
    base = [prose(rng.randrange(60, 300), rng) for _ in range(80)]
    near = base[3].split()
    near[40] = "changed"
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, base[0]), (101, " ".join(near)), (102, prose(20, rng)), (103, "again and again " * 60), (104, None), (105, ""), (106, " ".join("#$|" + w for w in prose(150, rng).split()))]
    rows += [(107, prose(60, rng) + " " + bench[0][1] + " " + prose(60, rng)), (108, bench[1][1] + " " + bench[2][1] + " " + prose(5, rng)), (109, prose(70, rng) + " three SHORT, words " + prose(20, rng))]
    rows += [(110, prose(50, rng) + " a.b@example.org or 10.1.2.3 and 4845168114407329, +1 (974) 555-3436 " + prose(20, rng)), (None, prose(100, rng))]
    docs = spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 2}", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, 1) for i in range(60)] + [(106, 0)]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(d, q, 0) for d, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held = lambda df: sorted_rows((r.doc_id, r.text) for r in df.collect())

    d2 = brute.op6_distances([("en", f"s{(d or 0) % 2}", t) for d, t in rows])
    of = dict(zip([d for d, _ in rows], d2, strict=True))
    cutoff = (max(of[d] for d, q in labels if q and of[d] is not None) * of[106]) ** 0.5
    kept = sorted_rows((d, t) for (d, t), x in zip(rows, d2, strict=True) if x is not None and x <= cutoff)
    got = corpus_pipeline.quality(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert held(got) == kept and {d for d, _ in kept}.isdisjoint({102, 103, 104, 105, 106}) and 107 in dict(kept)

    got = corpus_pipeline.near_duplicates(spark, got, str(tmp_path))
    ranked = [(d if d is not None else 1 << 40, t) for d, t in kept]
    ranked.sort()
    first = {c for _, c, _ in brute.op7(ranked)}
    kept = sorted_rows((d, t) for d, t in kept if (d if d is not None else 1 << 40) in first)
    assert held(got) == kept and {100, 101}.isdisjoint({d for d, _ in kept})

    got = corpus_pipeline.decontaminate(spark, got, str(tmp_path))
    cut = [(d, *brute.cut_hits(t, [x for _, x in bench if x])) for d, t in kept]
    kept = sorted_rows((d, t) for d, t, share in cut if share <= 0.5)
    assert held(got) == kept and 108 not in dict(kept) and "SHORT" not in dict(kept)[109] and bench[0][1][:40] not in dict(kept)[107]
    assert all(r.n_chars == len(r.text) for r in got.collect())

    got = corpus_pipeline.personal_data(spark, got, str(tmp_path))
    masked = []
    for d, t in kept:
        for span in reversed([s.split(":") for s in brute.op5(t)[1].split(",") if s]):
            t = t[: int(span[1])] + f"<{span[0]}>" + t[int(span[2]) :]
        masked.append((d, t))
    assert held(got) == masked and "<email> or <ip> and <card>, <phone>" in dict(masked)[110]

    e = _tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), False)
    pieces = corpus_pipeline.pack(spark, got, str(tmp_path)).collect()
    for d, t in masked:
        own = sorted((r for r in pieces if r.doc_id == d), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == np.array([*e.library.encode(t, add_special_tokens=False).ids, 2], e.dtype).tobytes()
    whole = sorted_rows((r.doc_id, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert whole == sorted_rows((r.doc_id, r.start, r.ids_crc32) for r in pieces)


def test_common_places_are_counted_on_every_set(spark, monkeypatch):
    from collections import Counter

    rng = np.random.default_rng(5)
    held = [np.where(rng.random(128) < 0.02, rng.integers(0, 3, 128), rng.integers(3, 1 << 31, 128)).astype("<u4") for _ in range(900)]
    for k in range(400):
        held[2 * k][7] = 5 if k < 128 + 1 else 6 if k < 2 * 128 + 1 else held[2 * k][7]  # one above the limit, and one at it
    held[0][9] = 0xFFFFFFFF
    rows = spark.createDataFrame([(i.to_bytes(16, "little"), bytes(h.tobytes())) for i, h in enumerate(held)], "fp binary, sketch binary")
    n = Counter((p, int(v)) for h in held for p, v in enumerate(h) if v != 0xFFFFFFFF)
    want = sorted(p << 32 | v for (p, v), c in n.items() if c > 128)
    assert want == [7 << 32 | 5]
    assert op7_chosen_path.common_places(rows).tolist() == want
    monkeypatch.setattr(op7_chosen_path, "SMALL", 3)
    want = sorted(p << 32 | v for (p, v), c in n.items() if c > 3)
    assert len(want) > 100 and op7_chosen_path.common_places(rows.repartition(5)).tolist() == want
    assert not len(op7_chosen_path.common_places(rows.limit(0)))


def test_decontamination_cuts_in_the_worker_that_scans(spark):
    """A second Python step in a task keeps a second worker, whose memory stays through all later stages of the pipeline."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, "é" + " ".join(words), 7), (2, None, 8), (3, " ".join(words[5:40] + ["tail"]), 9), (4, "\u3000x  " + " ".join([*words[:30], *words[45:]]), 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, " ".join(words[10:22])), (2, " ".join(words[46:58]))], "item_id long, text string")
    for size in (op10_decontaminate.MAX_WORDS, 12):  # one block, and several
        out = op10_decontaminate.clean(docs, bench, coverage=0.9, max_words=size)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
        got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
        want = {}
        for d, t, n in rows:
            for a, b in ((10, 22), (46, 58)):
                t = t and t.replace(" ".join(words[a:b]), "")
            want[d] = (t, n if t is None else len(t))
        assert got == want
