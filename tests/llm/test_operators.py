"""Each operator against a plain restatement, on odd rows and on the smallest driver tables."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from boxwright.llm import _tokens, op1_scoring, op2_records, op3_packing, op4_chat, op5_pii, op6_outliers, op7_chosen_path, op8_suffixes, op9_recompression, op10_decontaminate
from boxwright.llm._shared import shared_dir

public_tokenizers = pytest.importorskip("public_tokenizers")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
BASE = " ".join(f"tok{i * 7919 % 1009}" for i in range(120))
NEAR = BASE.replace("tok7919", "tok1").replace(BASE.split()[60], "changed")
ODD = [(0, None), (1, ""), (2, " \n\t "), (3, BASE), (4, BASE), (5, NEAR), (6, "short text"), (7, LONG), (8, LONG + " end"), (9, "a " * 300), (10, "x" * 5000), (11, "é👍 ñ\u3000— " * 40),
       (12, "mail a.b@c-d.example.org, +1 (974) 555-3436; 10.0.0.255 256.1.1.1 4845168114407329 token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" +12 1.2.3.4.5.6.7.8"), (13, BASE + " tail of its own"), (None, "no id " + BASE), (14, "line\nline\nline\n\nother")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en" if i % 3 else None, "src" if i % 2 else None, len(t or ""), i, "clash") for i, (d, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, bucket string").repartition(3)


@pytest.fixture(scope="module")
def small(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def pulled(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("file,keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_is_exact(file, keeps):
    e = _tokens.Encoder(public_tokenizers.path(file), keeps)
    rng = np.random.default_rng(3)
    parts = ["a", "B", "é", "the", "don't", " ", "\n", "  ", "\t", "“x”", "<|endoftext|>", "12", ".", ",", "İ", "\u3000", "的", "👍", "\0", "\x1c", "_", "\r\n"]
    for _ in range(30):
        some = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(20)] + [None]
        assert e.encode(some) == [np.array(e.library.encode(x or "", add_special_tokens=False).ids, e.dtype).tobytes() for x in some]


def test_scores(spark, docs, small):
    out = {r.doc_id: r for r in op1_scoring.score(docs).collect()}
    assert out[0].n_words == 0 and out[0].log_prob == 0 and out[0].mean_log_prob is None
    assert out[3].log_prob == out[4].log_prob < 0
    assert op1_scoring.score(empty(spark)).count() == 0


#: Nats a word by which neighbours must help on held-out documents of the smallest table.
GAIN = 0.02


def test_scores_beat_unigram(small):
    """Held out: the trained network predicts words of unseen documents better than class frequencies do."""
    train, held = small.where("doc_id % 5 <> 0").select("text"), texts(small.where("doc_id % 5 = 0"))
    top = op1_scoring.vocabulary(train)
    model = op1_scoring.train(train, top)
    import pyarrow as pa

    total = counts = n = 0
    uni = np.ones(op1_scoring.V)
    for _, _, h, _ in op1_scoring._word_hashes(pa.array([t for _, t in texts(train.withColumn("doc_id", F.lit(0)))])):
        uni += np.bincount(op1_scoring.classes(h, top), minlength=op1_scoring.V)
    uni = np.log(uni / uni.sum())
    for _, _, h, doc in op1_scoring._word_hashes(pa.array([t for _, t in held])):
        word = op1_scoring.classes(h, top)
        total, counts, n = total + op1_scoring.log_probs(model, word, doc).sum(), counts + uni[word].sum(), n + len(word)
    assert total / n > counts / n + GAIN


def test_every_word_has_its_own_probability(spark, docs, monkeypatch):
    """log_prob is the classes' part plus log(count of the word / count of its class) for every word beyond the top."""
    from collections import Counter

    import pyarrow as pa

    monkeypatch.setattr(op1_scoring, "BLOCK_WORDS", 500)  # many blocks
    rows = [*ODD, (15, "never "), (16, "before seen twice twice " * 2), (16, "another text of this doc_id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    top = op1_scoring.vocabulary(df.select("text"))
    model = op1_scoring.train(df.select("doc_id", "text"), top)
    hashed = [[x for _, _, h, _ in op1_scoring._word_hashes(pa.array([t], pa.string())) for x in h.tolist()] for _, t in rows]
    word = Counter(x for h in hashed for x in h)
    of = dict(zip(word, op1_scoring.classes(np.array(list(word), np.uint64), top).tolist(), strict=True))
    total = Counter()
    for x, n in word.items():
        total[of[x]] += n
    assert len(word) > 900 and max(total.values()) < sum(word.values())
    want = []
    for (d, _), h in zip(rows, hashed, strict=True):
        own = op1_scoring.log_probs(model, np.array([of[x] for x in h], np.int64), np.zeros(len(h), np.int64)).sum() if h else 0.0
        want.append((d, len(h), own + sum(np.log(word[x] / total[of[x]]) for x in h)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.n_words, r.log_prob) for r in op1_scoring.score(df).collect()), key=key)
    want.sort(key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], rtol=1e-4, atol=0.05)


def test_scores_gain_over_unigrams(spark):
    """Held-out text whose words follow from their neighbours: words are predicted better than by their frequencies."""
    import pyarrow as pa

    rng = np.random.default_rng(7)

    def text(n):
        at, out = rng.integers(0, 400, 2), []
        for k in range(n):
            at[k % 2] = (at[k % 2] + 1) % 400 if rng.random() < 0.95 else rng.integers(0, 400)
            out.append(f"w{at[0] // 40}" if k % 2 else f"v{at[0] // 40}x{rng.zipf(1.5) % 1000}")
        return " ".join(out)

    train, held = [text(1000) for _ in range(300)], [text(1000) for _ in range(30)]
    df = spark.createDataFrame([(t,) for t in train], "text string").coalesce(1)
    top = op1_scoring.vocabulary(df)
    model = op1_scoring.train(df, top)
    seen = np.concatenate([h for _, _, h, _ in op1_scoring._word_hashes(pa.array(train))])
    words, counts = np.unique(seen, return_counts=True)
    total = np.bincount(op1_scoring.classes(words, top), counts, op1_scoring.V)
    gain = n = 0
    for _, _, h, doc in op1_scoring._word_hashes(pa.array(held)):
        word, at = op1_scoring.classes(h, top), np.minimum(np.searchsorted(words, h), len(words) - 1)
        known = words[at] == h  # a word that the corpus does not hold has no probability from either
        within = np.log(counts[at] / total[word])
        model_part, unigram = op1_scoring.log_probs(model, word, doc) + within, np.log(counts[at] / counts.sum())
        gain, n = gain + (model_part - unigram)[known].sum(), n + known.sum()
    assert n > 25_000 and gain / n > 0.3


def test_records(spark, docs):
    folder = shared_dir(spark, "t")
    path = public_tokenizers.path("byte_bpe_50k.json")
    files = op2_records.write_records(docs, folder, path)
    e, want, start = _tokens.Encoder(path, True), [], 0
    for d, t in brute.order(ODD):
        ids = [*e.library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), brute.crc(ids)))
        start += len(ids)
    assert pulled(op2_records.read_records(spark, folder, files)) == want
    rec, before, n = files[-1]
    doc, ids = op2_records.read_one(folder, rec, n - 1)
    assert (doc, len(ids)) == (want[-1][0], want[-1][2])
    assert op2_records.read_records(spark, folder, op2_records.write_records(empty(spark), folder + "e", path)).count() == 0


def test_record_checksums():
    import io

    framed = op2_records.frame(b"payload")
    assert list(op2_records.unframe(io.BytesIO(framed * 2))) == [b"payload"] * 2
    for k in range(len(framed)):
        broken = framed[:k] + bytes([framed[k] ^ 1]) + framed[k + 1 :]
        with pytest.raises((ValueError, MemoryError, OverflowError)):
            list(op2_records.unframe(io.BytesIO(broken)))


def test_packing(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    e = _tokens.Encoder(path, False)
    rows = op3_packing.pack(docs, path).collect()
    ids = {d: [*e.library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in ODD}
    for d, want in ids.items():
        pieces = sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == np.array(want, e.dtype).tobytes()
        assert all(r.ids_crc32 == brute.crc(want[r.start : r.start + r.length]) and r.doc_tokens == len(want) for r in pieces)
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0
    assert op3_packing.pack(empty(spark), path).count() == 0


def test_hilbert_neighbours():
    grid = np.stack(np.meshgrid(np.arange(8), np.arange(8)), -1).reshape(-1, 2)
    key = op3_packing.hilbert(grid, 3)
    assert sorted(key) == list(range(64))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_chat(spark, sf_dir):
    odd = [(1, 0, "user", None), (1, 1, "assistant", "a\\s<s>[x]</s>\\"), (1, 1, "assistant", "a\\s<s>[x]</s>\\"), (1, 2, None, "q"), (2, 0, "assistant", ""), (None, None, "us]er", "[INST]"), (3, 0, "user", "only"), (-1, 0, "user", op4_chat.PROBE), (-1, 1, "assistant", op4_chat.PROBE)]
    df = spark.createDataFrame([(*r, "x") for r in odd], "conv_id long, turn long, role string, text string, turns string")
    assert {r[0]: tuple(r[1:5]) for r in op4_chat.digests(df).collect()} == brute.conversations(odd)
    assert op4_chat.examples(df.limit(0)).count() == 0
    first = op4_chat.examples(df).where("conv_id = -1 AND loss_start IS NOT NULL").first()
    assert first.formatted.count("</s>") == 2 and first.formatted[first.loss_start : first.loss_end].startswith("\\l/s>")


def test_pii(spark, docs, small):
    got = {r.doc_id: r for r in op5_pii.find_pii(docs).collect()}
    for d, t in ODD:
        assert (tuple(got[d][1:6])) == brute.op5(t)[0]
    assert "secret:" in {r.doc_id: r for r in op5_pii.find_pii(docs.unionByName(small.withColumns({"doc_id": F.col("doc_id") + 1000, "key": F.lit(0), "bucket": F.lit("")}))).collect()}[12].spans
    for d, t in texts(small):
        assert op5_pii.said(op5_pii.find(t, np.zeros(11))[0]) == brute.op5(t)[1]
    assert op5_pii.find_pii(empty(spark)).count() == 0
    masked = {r.doc_id: r.text for r in op5_pii.redact(docs).collect()}
    assert "a.b@c-d" not in masked[12] and masked[3] == BASE


def test_labeler_reliability():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < q, truth, ~truth) * 2 - 1 for q in (0.95, 0.9, 0.6)], 1)
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    post, table = op5_pii.expectation_maximisation(pattern, n.astype(float), np.full(len(n), np.nan))
    index = {tuple(p): q for p, q in zip(pattern, post, strict=True)}
    assert np.mean([(index[tuple(v)] > 0.5) == t for v, t in zip(votes, truth, strict=True)]) > 0.93
    assert table[0, 1, 2] > table[2, 1, 2]


def test_outliers(spark, docs, small, sf_dir):
    got = {r.doc_id: r for r in op6_outliers.judge(docs).collect()}
    for d, t in ODD:
        assert tuple(got[d][3:9]) == brute.op6(t)
        assert not (got[d].base_failed and got[d].kept)
    for r in op6_outliers.judge(small).join(small.select("doc_id", "text"), "doc_id").collect():
        assert tuple(r[3:9]) == brute.op6(r.text)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = op6_outliers.judge(small, labels=labels).join(labels, "doc_id").where("NOT base_failed").collect()
    assert all(r.kept == (r.quality == 1) for r in judged if r.quality is not None)
    assert op6_outliers.judge(empty(spark)).count() == 0


def test_join(spark, docs, small):
    rows = [r for r in ODD if r[0] is not None]
    got = pulled(op7_chosen_path.join(docs.where("doc_id IS NOT NULL")).select("doc_id", "class_id", "n_links"))
    assert got == brute.op7(rows)
    assert pulled(op7_chosen_path.join(small).select("doc_id", "class_id", "n_links")) == brute.op7(sorted(texts(small)))
    assert op7_chosen_path.join(empty(spark)).count() == 0
    kept = {r.doc_id for r in op7_chosen_path.stage(spark, docs, "").collect()}
    assert {3, 6, 7} <= kept and not kept & {4, 1, 2}


def test_large_near_copies(spark, monkeypatch):
    """More near copies than a node or block holds: split nodes, block pairs and label propagation all take part."""
    monkeypatch.setattr(op7_chosen_path, "SMALL", 8)
    monkeypatch.setattr(op7_chosen_path, "BLOCK", 16)
    rng, base = np.random.default_rng(5), BASE.split()
    rows = []
    for i in range(60):
        w = list(base)
        w[int(rng.integers(0, 120))] = f"own{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join([*base[:30], *(f"u{i}x{k}" for k in range(120))])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pulled(op7_chosen_path.join(df).select("doc_id", "class_id", "n_links")) == brute.op7(rows)


def test_recall_in_deep_nodes(spark, monkeypatch):
    """Pairs at exactly 0.8, one text the beginning of the other, in nodes that are all split down to the last level."""
    monkeypatch.setattr(op7_chosen_path, "SMALL", 1)
    monkeypatch.setattr(op7_chosen_path, "DENSE", 2.0)
    rows = []
    for i in range(1200):
        w = [f"d{i}w{k}" for k in range(129)]
        rows += [(2 * i, " ".join(w[:104])), (2 * i + 1, " ".join(w))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    links = dict(pulled(op7_chosen_path.join(df).select("doc_id", "n_links")))
    assert max(links.values()) == 1 and sum(n == 0 for n in links.values()) <= 2  # 1 - RECALL of them: 0.1 pairs


def test_runs_follow_from_depth():
    assert op7_chosen_path.missed(op7_chosen_path.RUNS, op7_chosen_path.DEPTH) <= 1 - op7_chosen_path.RECALL < op7_chosen_path.missed(op7_chosen_path.RUNS - 1, op7_chosen_path.DEPTH)


def test_suffixes(spark, docs):
    want = brute.op8([r for r in ODD if r[0] != 7 and r[0] != 8])
    got = op8_suffixes.remove_repeats(docs.where("doc_id IS NULL OR doc_id NOT IN (7, 8)")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert pulled(got) == want
    assert op8_suffixes.remove_repeats(empty(spark)).count() == 0


def test_recompression(spark, docs):
    rows = [r for r in ODD if r[0] is not None]
    got = op9_recompression.remove_repeats(docs.where("doc_id IS NOT NULL")).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256))
    assert pulled(got) == brute.op9(rows)
    assert op9_recompression.remove_repeats(empty(spark)).count() == 0


def test_symbols_depend_on_their_stretch_only():
    rng = np.random.default_rng(1)
    word = rng.integers(0, 40, 4000).astype(np.uint64)
    word[100:140] = 7
    word[1000:1300] = word[3000:3300]
    levels = list(op9_recompression.symbols(word, np.array([0, 2000, 4000])))
    for name, lo, hi in levels:
        assert (np.diff(lo) >= 0).all() and (np.diff(hi) >= 0).all()
        inside = [{(a - base, n) for n, a, b in zip(name.tolist(), lo.tolist(), hi.tolist(), strict=True) if base <= a and b <= base + 300} for base in (1000, 3000)]
        assert inside[0] == inside[1]


def test_decontamination(spark, docs):
    items = [(1, " ".join(BASE.split()[10:40]).upper()), (2, "short TEXT"), (3, None), (4, ""), (5, "never seen anywhere at all in here I think so yes"), (2, "short text")]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    want = sorted(brute.op10(ODD, items), key=lambda r: (r[0] is not None, r[0] or 0))
    for words in (op10_decontaminate.MAX_WORDS, 12):  # one block, and several
        out = op10_decontaminate.scan(docs, bench, max_words=words).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", F.col("n_hit") > 0)
        assert pulled(out) == want
    assert op10_decontaminate.scan(empty(spark), bench).count() == 0
    assert pulled(op10_decontaminate.scan(docs, bench.limit(0)).select("doc_id", "n_hit")) == [(r[0], 0) for r in want]
    cleaned = {r.doc_id: r.text for r in op10_decontaminate.clean(docs, bench).collect()}
    assert 6 not in cleaned and "tok" + str(7919 * 20 % 1009) not in cleaned[3].split()[:11] and cleaned[10] == "x" * 5000


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, sf_dir)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "personal_data", "pack"]
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    kept = {r.doc_id for r in op6_outliers.judge(first).where("kept").collect()}
    clusters = dict(pulled(op7_chosen_path.join(first.where(F.col("doc_id").isin(list(kept)))).select("doc_id", "class_id")))
    assert ids <= kept and len({clusters[d] for d in ids}) == len(ids)
