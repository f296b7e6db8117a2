"""Image headers, scans, frames, scoring, archives, caches; polygons and outlines."""

import random
import struct
import zipfile
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxwright.operators import masks as K
from boxwright.operators import rows as R
from boxwright.sources import files as S
from boxwright.sources import media as V


def png(w, h):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" * (3 * w + 1) * h)) + chunk(b"IEND", b"")


def jpeg(w, h, fill=b"\x10"):
    return b"\xff\xd8\xff\xe0\x00\x04ab" + b"\xff\xc0\x00\x0b\x08" + struct.pack(">HH", h, w) + b"\x01\x01\x11\x00" + b"\xff\xda\x00\x02" + fill * 20 + b"\xff\xd9"


def test_headers():
    tiff = b"II*\0\x08\0\0\0\x02\0" + struct.pack("<HHIHH", 256, 3, 1, 7, 0) + struct.pack("<HHII", 257, 4, 1, 9)
    assert V.header(png(8, 9)) == ("png", 8, 9) and V.header(jpeg(30, 20)) == ("jpeg", 30, 20) and V.header(tiff) == ("tiff", 7, 9)
    assert V.header(V.bitmap(np.zeros((5, 6, 3), np.uint8))) == ("bmp", 6, 5)
    assert V.header(b"PF\n4 3\n-1.0\n") == ("pfm", 4, 3)
    assert V.header(b"RIFF....WEBPVP8X" + b"\0" * 8 + b"\x09\0\0\x04\0\0") == ("webp", 10, 5)
    for bad in (None, b"", b"x\xff\xd9", b"\xff\xd8\xff", png(8, 9)[:14], b"BM"):
        assert V.header(bad) == (None, None, None)


def test_upload_check(spark):
    """An image passes; a wrong suffix, bytes that are no image, nothing and too much do not."""
    rows = [("a.png", png(8, 8)), ("a.txt", png(8, 8)), ("a.jpg", b"x\xff\xd9"), ("a.jpg", b""), ("a.jpg", None), ("a.jpg", jpeg(8, 8, b"0" * 100))]
    df = spark.createDataFrame(rows, "name string, content binary").withColumn("head", V.image_header("content"))
    got = [r.s for r in df.select(V.upload_status(F.col("name"), F.col("content"), F.col("head"), 1000).alias("s")).collect()]
    assert got == ["ok", "suffix", "image", "empty", "empty", "size"]


def test_verified_images(spark):
    rows = [(1, png(8, 30)), (2, jpeg(40, 30)), (3, jpeg(40, 30)[:-1]), (4, b"no"), (5, None)]
    got = {r.image_id: r for r in R.image_status(V.verified_images(spark.createDataFrame(rows, "image_id int, content binary")), [*S.IMAGES]).collect()}
    assert [got[k].status for k in range(1, 6)] == ["size", "ok", "ok", "unreadable", "unreadable"]
    assert [got[k].trailer for k in (1, 2, 3)] == [None, True, False]


def test_scans(spark, tmp_path):
    for name in ("b/2.JPG", "b/1.png", "v/clip.mp4", "b/no.txt2"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "list.txt").write_text("./b/2.JPG\n\n/abs/3.bmp\n./b/no.txt2\n")
    names = lambda df: [r.path.rsplit("/", 1)[1] for r in df.collect()]
    assert names(V.scan(spark, str(tmp_path), f"{tmp_path}/b/*.png")) == ["1.png", "2.JPG", "clip.mp4"]
    assert names(V.listed(spark, f"{tmp_path}/list.txt")) == ["3.bmp", "2.JPG"]
    assert sorted(names(V.training_scan(spark, f"{tmp_path}/b", f"{tmp_path}/list.txt"))) == ["1.png", "2.JPG", "2.JPG", "3.bmp"]  # a URI and a path
    folders = {(r.name, r.cls) for r in S.class_folders(spark, str(tmp_path / "b")).collect()}
    assert folders == {("b", 0)}


def test_images_in_memory(spark, tmp_path):
    (tmp_path / "f.png").write_bytes(png(3, 2))
    a = np.arange(4 * 5 * 3, dtype=np.uint8).reshape(4, 5, 3)
    rows = V.verified_images(V.in_memory(spark, [jpeg(6, 7), a, str(tmp_path / "f.png")])).orderBy("image_id").collect()
    assert [(r.format, r.width, r.height) for r in rows] == [("jpeg", 6, 7), ("bmp", 5, 4), ("png", 3, 2)]
    assert (V.decoded_bitmap(bytes(rows[1].content)) == a).all()


def test_video_frames(spark, tmp_path):
    clip = b"RIFFxxxxAVI " + b"".join(b"00dc" + jpeg(10 + k, 5) for k in range(7)) + b"\xff\xd8\xff cut"
    (tmp_path / "a.avi").write_bytes(clip)
    (tmp_path / "a.jpg").write_bytes(jpeg(1, 1))
    got = V.video_frames(spark, str(tmp_path), 3).orderBy("frame_no").collect()
    assert [(r.frame_no, r.width) for r in got] == [(3, 12), (6, 15)] and bytes(got[0].payload) == jpeg(12, 5)


def test_frames_leave_in_bounded_batches():
    clips = pa.RecordBatch.from_arrays([pa.array([f"{k}.avi" for k in range(3000)] + ["none"]), pa.array([jpeg(5, 6) * 3] * 3000 + [None])], ["path", "content"])
    sizes = [b.num_rows for b in V.frame_batches(iter([clips, clips.slice(0, 1)]))]
    assert len(sizes) == 3 and max(sizes) == V.FRAMES and sum(sizes) == 9003
    large = pa.RecordBatch.from_arrays([pa.array(["l.avi"]), pa.array([(jpeg(5, 6)[:-2] + bytes(3 << 20) + jpeg(5, 6)[-2:]) * 7])], ["path", "content"])
    assert [b.num_rows for b in V.frame_batches(iter([large]))] == [3, 3, 1] and not list(V.frame_batches(iter([])))


def test_frame_stream_stop_and_hooks(spark, tmp_path):
    from boxwright.streaming import frames as streams

    for source, n in (("cam1", 3), ("cam2", 2)):
        (tmp_path / "in" / source).mkdir(parents=True)
        for k in range(1, n + 1):
            (tmp_path / "in" / source / f"{k}.jpg").write_bytes(jpeg(10, 10))
    seen, hooks = [], V.Hooks()
    hooks.register("on_started", lambda e: seen.append("started"))
    hooks.register("on_started", lambda e: seen.append("again"))
    with pytest.raises(ValueError, match="no hook"):
        hooks.register("on_lunch", print)
    spark.streams.addListener(hooks)
    try:
        frames = V.frame_stream(spark, str(tmp_path / "in"))
        query = streams.counts(frames.drop("payload")).writeStream.format("memory").queryName("cams").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).start()
        calls = iter([False, True, True])
        assert V.stop_when_any_ends(query, lambda: next(calls), 0.1, 60)
        assert not query.isActive and {r.source_id: r.n for r in spark.table("cams").collect()} == {"cam1": 3, "cam2": 2}
    finally:
        spark.streams.removeListener(hooks)
    assert seen[:2] == ["started", "again"]


def test_scored_loads_a_model_once_a_worker(spark):
    def load():
        import os

        made = os.urandom(8).hex()
        return lambda f: pd.DataFrame({"image_id": f["id"], "obj": f["id"] / 10.0, "scores": [[0.1 * k, 0.5] for k in f["id"]], "made": made})

    out = V.scored(spark.range(40, numPartitions=2), "test-model", load, "image_id long, obj double, scores array<double>, made string").collect()
    assert len(out) == 40 and out[3].scores == [0.1 * out[3].image_id, 0.5]
    assert len({r.made for r in out}) <= 8  # worker processes, not batches or rows


def test_archive_and_next_path(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("d/sub/deep.yaml", "x")
        z.writestr("d/data.yaml", "path: /d\ntrain: a\nnames: [cat, dog]\n")
    found = V.unpacked(str(tmp_path / "d.zip"), str(tmp_path / "out"))
    assert found.endswith("d/data.yaml") and S.dataset_yaml(spark, found)[1].count() == 2
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../x.yaml", "x")
    with pytest.raises(ValueError, match="outside"):
        V.unpacked(str(tmp_path / "bad.zip"), str(tmp_path / "out2"))
    base = tmp_path / "exp"
    assert V.next_path(str(base)) == str(base)
    base.mkdir()
    (tmp_path / "exp2").mkdir()
    assert V.next_path(str(base)) == str(base) + "3"


def test_label_cache(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "path string, cls int")
    assert V.read_label_cache(spark, "d", str(tmp_path / "c")) is None
    V.write_label_cache(rows, "d", str(tmp_path / "c"))
    assert V.read_label_cache(spark, "d", str(tmp_path / "c")).collect() == rows.collect()
    assert V.read_label_cache(spark, "other", str(tmp_path / "c")) is None


def test_crops_by_class(spark, tmp_path):
    a = np.arange(10 * 12 * 3, dtype=np.uint8).reshape(10, 12, 3)
    rows = spark.createDataFrame([(1, 0, 2, -3.0, 1.0, 4.0, 5.0, V.bitmap(a)), (1, 1, 0, 50.0, 1.0, 60.0, 5.0, V.bitmap(a))], "image_id long, det_id long, cls int, x1 double, y1 double, x2 double, y2 double, content binary")
    cut = V.crops(rows, V.decoded_bitmap)
    (only,) = cut.collect()
    assert (V.decoded_bitmap(bytes(only.content)) == a[1:5, 0:4]).all()
    V.write_class_folders(cut, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).first().cls == 2


def inside(x, y, xs, ys):
    odd = False
    for xa, ya, xb, yb in zip(xs, ys, xs[1:] + xs[:1], ys[1:] + ys[:1], strict=True):
        if (ya <= y) != (yb <= y) and x < xa + (y - ya) * (xb - xa) / (yb - ya):
            odd = not odd
    return odd


def test_scan_lines_against_points():
    rng = random.Random(1)
    for _ in range(30):
        n = rng.randrange(3, 8)
        xs, ys = [rng.uniform(-3, 20) for _ in range(n)], [rng.uniform(-3, 15) for _ in range(n)]
        got = {(x, y) for y, a, b in K.scan_lines(xs, ys) for x in range(a, b)}
        assert got == {(x, y) for x in range(-5, 25) for y in range(-5, 20) if inside(x + 0.5, y + 0.5, xs, ys)}
    assert K.scan_lines([], []) == [] and K.scan_lines([1.0], [1.0]) == []


def test_scan_batch_gives_the_runs_of_scan_lines(monkeypatch):
    monkeypatch.setattr(K, "CELLS", 40)  # so that polygons are cut between chunks
    rng = random.Random(3)
    shapes = [[(rng.choice((rng.uniform(-9, 20), rng.randrange(-9, 20) + 0.5)), rng.choice((rng.uniform(-9, 20), rng.randrange(-9, 20) / 2))) for _ in range(rng.randrange(0, 9))] for _ in range(200)]
    xs, ys = (np.array([float(p[c]) for s in shapes for p in s]) for c in (0, 1))
    offs = np.cumsum([0] + [len(s) for s in shapes])
    got = sorted(r for b in K.scan_batch(xs, ys, offs) for r in zip(*(c.tolist() for c in b), strict=True))
    assert got == sorted((i, *r) for i, s in enumerate(shapes) for r in K.scan_lines([float(p[0]) for p in s], [float(p[1]) for p in s]))
    with pytest.raises(ValueError, match="finite"):
        list(K.scan_batch(np.array([0.0, np.nan]), np.zeros(2), np.array([0, 2])))


def test_polygon_areas_count_the_runs(spark):
    shapes = [(1, 1, None), (1, 2, []), (1, 3, [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]), (2, 1, [(0.0, 0.0), (9.0, 0.0), (0.0, 7.0)]), (2, 2, [(0.0, 0.0), (0.1, 0.1), (0.0, 0.1)])]
    df = spark.createDataFrame(shapes, "image_id long, obj_id int, points array<struct<x:double,y:double>>")
    runs = K.polygon_runs(df).groupBy("image_id", "obj_id").agg(F.count("*").alias("lines"), F.sum(F.col("x1") - F.col("x0")).alias("cells"))
    assert sorted(tuple(r) for r in K.polygon_areas(df).collect()) == sorted(tuple(r) for r in runs.collect()) == [(1, 3, 2, 4), (2, 1, 7, 31)]


def test_outlines_give_the_mask_back(spark):
    rng = random.Random(2)
    for _ in range(40):
        cells = {(x, y) for x in range(6) for y in range(6) if rng.random() < 0.55}
        runs = [(y, x, x + 1) for x, y in cells]
        points = K.outline(runs)
        if not cells:
            assert points == []
            continue
        filled = {(x, y) for y, a, b in K.scan_lines([float(p[0]) for p in points], [float(p[1]) for p in points]) for x in range(a, b)}
        assert all(p[0] == q[0] or p[1] == q[1] for p, q in zip(points, points[1:] + points[:1], strict=True))
        assert filled & cells and all(any((x + dx, y) in filled | {(x + dx, y)} for dx in (-1, 1)) for x, y in filled)
    square = K.outline([(y, 2, 5) for y in range(1, 4)])
    assert sorted(square) == [(2, 1), (2, 4), (5, 1), (5, 4)]
    ring = K.outline([(0, 0, 3), (1, 0, 1), (1, 2, 3), (2, 0, 3)])
    assert sorted(ring) == [(0, 0), (0, 3), (3, 0), (3, 3)]  # holes are no outline
    two = K.outline([(0, 0, 1), (5, 5, 8), (6, 5, 6)])
    assert len(two) == 6
    df = spark.createDataFrame([(1, 1, 0, 0, 2), (1, 1, 1, 0, 2)], "image_id long, obj_id int, y int, x0 int, x1 int")
    (r,) = K.outlines(df).collect()
    assert len(r.points) == 4


def test_empty_polygons_have_no_runs(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, []), (1, 3, [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])], "image_id long, obj_id int, points array<struct<x:double,y:double>>")
    assert sorted(tuple(r) for r in K.polygon_runs(df).collect()) == [(1, 3, 0, 0, 2), (1, 3, 1, 0, 2)]


def test_with_fallback(spark):
    from boxwright.streaming import frames as streams

    rows = spark.createDataFrame([(None, None), (float("nan"), b"x"), (0.0, b""), (25.0, b"y")], "fps double, payload binary")
    assert [(r.fps, bytes(r.payload)) for r in streams.with_fallback(rows).collect()] == [(30.0, b""), (30.0, b"x"), (30.0, b""), (25.0, b"y")]


def test_written_predictions(spark, tmp_path):
    rows = spark.createDataFrame([("i1", "cat", 0.456)], "image_id string, name string, conf double")
    S.write_predictions(rows, str(tmp_path / "p"))
    (r,) = spark.read.option("header", True).csv(str(tmp_path / "p")).collect()
    assert (r.image, r.name, r.confidence) == ("i1", "cat", "0.46")


def test_cells_of_confidence_fall(spark):
    from boxwright.operators import detection as M

    conf = sorted({0.0, 1.0, 1e-30, 1 / 16, *(random.Random(3).random() ** 4 for _ in range(2000))}, reverse=True)
    rows = spark.createDataFrame([(c,) for c in conf], "conf double").select("conf", M.cell(F.col("conf")).alias("b")).orderBy(F.desc("conf")).collect()
    cells = [r.b for r in rows]
    assert cells == sorted(cells) and 0 <= cells[0] and cells[-1] < M.BUCKETS
