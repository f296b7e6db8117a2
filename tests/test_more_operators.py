"""Edge cases of masks, sampling, choices, run logs and scalars on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from boxwright.functions import scalars as C
from boxwright.operators import masks as K
from boxwright.operators import runs as U
from boxwright.operators import sampling as P
from boxwright.operators import selection as L
from boxwright.sources import logs as W

RUN = "image_id long, obj_id int, y int, x0 int, x1 int"


def test_rle_counts_against_pixels(spark):
    rows = [(1, 1, 0, 0, 2), (1, 1, 1, 0, 2), (1, 2, 2, 3, 9), (1, 3, 0, 0, 4), (1, 3, 1, 0, 4), (1, 3, 2, 0, 4), (1, 4, 1, 1, 3), (1, 4, 1, 2, 4), (1, 5, 7, 0, 1)]
    got = {r.obj_id: r.counts for r in K.rle_counts(spark.createDataFrame(rows, RUN), 4, 3).collect()}
    for obj in (1, 2, 3, 4):
        on = {x * 3 + y for _, o, y, a, b in rows if o == obj for x in range(a, min(b, 4))}
        want, last = [0], 0
        for p in range(12):
            if (p in on) != last:
                want.append(0)
                last = p in on
            want[-1] += 1
        assert got[obj] == want
    assert 5 not in got  # outside the image


def test_mask_iou_and_layers(spark):
    a = spark.createDataFrame([(1, 1, 0, 0, 4), (1, 1, 1, 0, 4)], RUN)
    b = spark.createDataFrame([(1, 7, 1, 2, 6), (1, 8, 5, 0, 4), (2, 7, 0, 0, 4)], RUN)
    (r,) = K.mask_iou(a, b).collect()
    assert (r.a_id, r.b_id, r.overlap) == (1, 7, 2) and math.isclose(r.iou, 2 / (10 + 1e-7))
    assert K.mask_iou(a.limit(0), b).count() == 0
    assert {r.obj_id: r.layer for r in K.layers(b.where("image_id = 1").unionByName(a)).collect()} == {1: 1, 7: 2, 8: 3}


@pytest.mark.parametrize("n", [0, 1, 7, 8])
def test_shards_are_equal_and_cover_all(spark, n):
    got = P.shards(spark.range(n), "id", 4).collect()
    assert {r.id for r in got} == set(range(n))
    sizes = {s: sum(r.shard == s for r in got) for s in range(4)}
    assert n < 4 or set(sizes.values()) == {-(-n // 4)}


def test_dealt_is_a_permutation_with_repeated_keys(spark):
    rows = spark.range(500).select((F.col("id") % 7).alias("id"))
    assert sorted(r.idx for r in P.dealt(rows, "id", "s").collect()) == list(range(500))


def test_weighted_draws_follow_the_weights(spark):
    rows = spark.createDataFrame([(1, 1), (2, 0), (3, 9), (4, 90)], "id long, w long")
    got = P.weighted_draws(rows, "id", "w", 2000).collect()
    share = {k: sum(r.id == k for r in got) / 2000 for k in (1, 2, 3, 4)}
    assert len(got) == 2000 and share[2] == 0 and abs(share[4] - 0.9) < 0.03 and abs(share[3] - 0.09) < 0.03
    assert P.weighted_draws(rows.where("w = 0"), "id", "w", 10).count() == 0
    assert P.weighted_draws(rows, "id", "w", 50, parts=3).count() == 50


def test_padded_top_fills_slots(spark):
    det = spark.createDataFrame([(1, 1, 0, 0.9), (1, 2, 0, 0.8), (1, 3, 0, 0.7), (1, 4, 1, 0.75)], "image_id long, det_id int, cls int, conf double")
    got = sorted((r.slot, r.cls, r.conf, r.valid) for r in L.padded_top(det, 2, 4).collect())
    assert got == [(0, 0, 0.9, True), (1, 0, 0.8, True), (2, 1, 0.75, True), (3, -1, 0.0, False)]


def test_next_population_stays_in_bounds(spark):
    log = spark.createDataFrame([(0.5, 0.01, 3.0), (0.9, 0.02, 5.0), (0.1, 0.001, 1.0)], "fit double, lr double, box double")
    bounds = {"lr": (0.001, 0.02), "box": (1.0, 4.0)}
    for seed in range(5):
        got = U.next_population(log, "fit", bounds, size=12, elite=1, seed=seed)
        assert len(got) == 12 and got[0] == {"lr": 0.02, "box": 5.0}  # the best row stays as it is
        assert all(0.001 <= g["lr"] <= 0.02 and 1.0 <= g["box"] <= 4.0 for g in got[1:])
        assert got == U.next_population(log, "fit", bounds, size=12, elite=1, seed=seed)
    still = U.next_population(log, "fit", bounds, size=9, rate=0.0)
    assert {g["lr"] for g in still} <= {0.01, 0.02, 0.001}  # crossing alone makes no new value
    with pytest.raises(ValueError, match="no rows"):
        U.next_population(log.limit(0), "fit", bounds)
    assert U.best_settings(log, "fit", ["lr", "box"]) == "# fitness: 0.9\nlr: 0.02\nbox: 5\n"


def test_first_of_tied_maxima_is_best(spark):
    log = spark.createDataFrame([(1, 1, 0.2), (1, 2, 0.9), (1, 3, 0.9), (2, 1, 0.1)], "run_id int, epoch int, fit double")
    assert {r.run_id: r.epoch for r in U.best_row(log).collect()} == {1: 2, 2: 1}
    assert U.until_best(log).count() == 3
    flat = U.gaussian(log.where("run_id = 2"), "fit").first()
    assert math.isclose(flat.smooth, 0.1)  # one row: the mirrored ends are that row


def test_scalars(spark):
    r = spark.range(1).select(C.url_name(F.lit("https://h/a/b%20c.zip?x=1/2#f")).alias("u"), C.is_ascii(F.lit("é")).alias("a"), C.is_chinese(F.lit("x中")).alias("c"), *(c.alias(n) for n, c in zip("rgb", C.hex_rgb(F.lit("#FF3800")), strict=True)), C.bce(F.lit(800.0), F.lit(1.0)).alias("big")).first()
    assert tuple(r) == ("b c.zip", False, True, 255, 56, 0, 0.0)


def test_butterworth_halves_power_at_the_cutoff():
    import numpy as np

    for order, cutoff in ((1, 0.5), (2, 0.2), (5, 0.06)):
        b, a = U.butterworth(order, cutoff)
        at = np.exp(1j * math.pi * cutoff * np.arange(order + 1) * -1)
        assert math.isclose(abs((b @ at) / (a @ at)), math.sqrt(0.5), rel_tol=1e-6)
    with pytest.raises(ValueError, match="cutoff"):
        U.butterworth(2, 1.0)


def test_zero_phase_keeps_slow_parts_and_drops_fast_ones(spark):
    n = 400
    rows = [(1, i, math.sin(2 * math.pi * i / 100) + 0.5 * (-1) ** i) for i in range(n)] + [(2, i, 3.0) for i in range(5)] + [(3, 0, None)]
    got = U.zero_phase(spark.createDataFrame(rows, "run_id int, epoch int, fit double"), "fit", 0.2).collect()
    slow = {r.epoch: r.smooth for r in got if r.run_id == 1}
    assert len(slow) == n and all(abs(slow[i] - math.sin(2 * math.pi * i / 100)) < 0.01 for i in range(50, n - 50))
    assert all(math.isclose(r.smooth, 3.0, rel_tol=1e-6) for r in got if r.run_id == 2)
    assert [r.smooth for r in got if r.run_id == 3] == [0.0]


def test_logs_and_statistics(spark, tmp_path):
    import json

    log = spark.createDataFrame([(1, 0.5), (2, 0.7)], "epoch int, fit double")
    for _ in range(2):
        W.append_log(log, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    stats = spark.createDataFrame([("a", None, 5, 2, 1), ("a", 1, 2, 1, 0), ("a", 0, 3, 2, 0)], "split string, cls int, instances long, labelled long, unlabelled long")
    got = json.loads(W.stats_json(stats).first().json)
    assert got == {"total": {"instances": 5, "labelled": 2, "unlabelled": 1}, "per_class": [{"cls": 0, "instances": 3, "labelled": 2}, {"cls": 1, "instances": 2, "labelled": 1}]}


def test_follow_log_writes_each_row_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for k in range(2):
        spark.range(k * 3, k * 3 + 3).write.mode("append").parquet(source)
        W.follow_log(spark.readStream.schema("id long").parquet(source), out, mark).awaitTermination(60)
    assert sorted(r.id for r in spark.read.json(out).collect()) == list(range(6))


def test_masks_overlap_in_the_row_of_their_pair(spark, sf_dir):
    """box_mask_map deals out no row a scan line, and overlaps in a row are those of mask_iou()."""
    import re

    from boxwright.plans.wider import box_mask_map

    plan = box_mask_map(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Generate explode\(sequence\(.*\[y#\d+\]", plan)
    shapes = [[(0, 0, 4), (1, 0, 4)], [(0, 2, 6), (0, 8, 9), (1, 3, 4)], [(1, -3, 1), (2, 0, 90)], [(7, 0, 1)], [(0, 0, 1), (0, 3, 4), (0, 8, 12)]]
    arrays = spark.createDataFrame([(1, k, r) for k, r in enumerate(shapes)], "image_id long, obj_id int, runs array<struct<y:int,x0:int,x1:int>>")
    runs = arrays.select("image_id", "obj_id", F.explode("runs").alias("r")).select("image_id", "obj_id", "r.*")
    both = arrays.select("image_id", F.col("obj_id").alias("a_id"), F.col("runs").alias("a")).join(arrays.select("image_id", F.col("obj_id").alias("b_id"), F.col("runs").alias("b")), "image_id")
    got = both.select("a_id", "b_id", K.lines_iou(F.col("a"), F.col("b")).alias("iou"))
    want = {(r.a_id, r.b_id): r.iou for r in K.mask_iou(runs, runs).collect()}
    assert {(r.a_id, r.b_id): r.iou for r in got.where("iou IS NOT NULL").collect()} == want and len(want) == 13
    boxes = spark.createDataFrame([(1, 0, -7, 3, 55, 19), (1, 1, 40, 40, 40, 40), (1, 2, 5, -30, 81, 200)], "image_id long, obj_id int, x1 int, y1 int, x2 int, y2 int")
    lines = boxes.select("obj_id", F.explode(K.box_lines([F.col(c) for c in ("x1", "y1", "x2", "y2")], 20)).alias("r")).select("obj_id", "r.*")
    assert sorted(map(tuple, lines.collect())) == sorted(tuple(r)[1:] for r in K.box_runs(boxes, "obj_id", 20).collect())
