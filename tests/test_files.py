"""Readers and writers on files written here; frame streams."""

import json

from pyspark.sql import functions as F

from boxwright.functions import geometry as G
from boxwright.operators import dataset as D
from boxwright.sources import files as S
from boxwright.streaming import frames as R


def test_label_rows(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.2 0.2\n1 1.5 0.5 0.2 0.2\n2 -0.1 0.5 0.2 0.2\n3 0.5 0.5 0.2\n")
    (tmp_path / "b.txt").write_text("4 0.1 0.1 0.3 0.1 0.3 0.5\n")
    (tmp_path / "c.txt").write_text("\n")
    got = {(r.path.rsplit("/", 1)[1], r.line): r for r in S.label_rows(spark, str(tmp_path)).collect()}
    assert [got["a.txt", k].status for k in range(4)] == ["ok", "outside", "negative", "fields"]
    b = got["b.txt", 0]
    assert b.status == "ok" and [round(v, 6) for v in (b.x, b.y, b.w, b.h)] == [0.2, 0.3, 0.2, 0.4] and len(b.points) == 3
    assert got["c.txt", None].status == "empty"


def test_paths(spark):
    r = spark.createDataFrame([("/d/images/x/images/p.q.JPG",)], "path string").select(S.label_path(F.col("path")).alias("l"), S.stem(F.col("path")).alias("s"), S.suffix(F.col("path")).alias("e")).first()
    assert (r.l, r.s, r.e) == ("/d/images/x/labels/p.q.txt", "p.q", "jpg")


def test_dataset_yaml(spark, tmp_path):
    (tmp_path / "d.yaml").write_text("# note\npath: /data\ntrain: [a, b]\nval:\n  - a\nnames:\n  0: cat\n  1: dog\n")
    splits, names = S.dataset_yaml(spark, str(tmp_path / "d.yaml"))
    assert sorted(map(tuple, splits.collect())) == [("train", "/data/a"), ("train", "/data/b"), ("val", "/data/a")]
    assert sorted(map(tuple, names.collect())) == [(0, "cat"), (1, "dog")]
    images = spark.createDataFrame([("/data/a/1.jpg",), ("/data/c/2.jpg",)], "path string")
    assert sorted(map(tuple, S.split_bridge(splits, images).collect())) == [("train", "/data/a/1.jpg"), ("val", "/data/a/1.jpg")]


def test_annotations(spark, tmp_path):
    doc = {"images": [{"id": 7, "file_name": "i.jpg", "width": 100, "height": 50}], "categories": [{"id": 3, "name": "cat"}], "annotations": [{"image_id": 7, "category_id": 3, "bbox": [-10, 0, 30, 20], "iscrowd": 0}, {"image_id": 7, "category_id": 3, "bbox": [0, 0, 1, 1], "iscrowd": 1}]}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    (row,) = S.coco_annotations(spark, str(tmp_path / "c.json")).collect()
    assert (row.image, row.name, row.x, row.y, row.w, row.h) == ("i.jpg", "cat", 0.1, 0.2, 0.2, 0.4)
    obj = lambda n, d: f"<object><name>{n}</name><difficult>{d}</difficult><bndbox><xmin>11</xmin><ymin>11</ymin><xmax>31</xmax><ymax>21</ymax></bndbox></object>"
    (tmp_path / "v.xml").write_text(f"<annotation><filename>v.jpg</filename><size><width>100</width><height>50</height></size>{obj('dog', 0)}{obj('dog', 1)}{obj('cow', 0)}</annotation>")
    (row,) = S.voc_annotations(spark, str(tmp_path / "v.xml"), ["cat", "dog"]).collect()
    assert (row.image, row.cls, row.x, row.y, row.w, row.h) == ("v.jpg", 1, 0.2, 0.3, 0.2, 0.2)
    (tmp_path / "d.csv").write_text("10,20,4,6,1,3\n1,1,1,1,0,2\n")
    (row,) = S.drone_rows(spark, str(tmp_path / "d.csv")).collect()
    assert (row.cls, row.x, row.y) == (2, 12.0, 23.0)
    (tmp_path / "s.csv").write_text("i.jpg,0,0,10,20,thing,100,200\n")
    assert tuple(S.shelf_rows(spark, str(tmp_path / "s.csv")).first()) == ("i.jpg", 0, 0.05, 0.05, 0.1, 0.1)
    (tmp_path / "p.json").write_text(json.dumps({"images": [{"name": "a"}, {"name": "b"}], "annotations": [{"image_id": 1, "category_id": 2, "bbox": [0, 0, 192, 120]}]}))
    assert tuple(S.positional_json(spark, str(tmp_path / "p.json")).first()) == ("b", 2, 0.05, 0.05, 0.1, 0.1)
    feature = lambda t, b: {"properties": {"image_id": "x.tif", "type_id": t, "bounds_imcoords": b}}
    (tmp_path / "g.json").write_text(json.dumps({"features": [feature(1, "1,2,3,4"), feature(0, "1,2,3,4"), feature(1, "1,2,oops,4")]}))
    assert [tuple(r) for r in S.geojson_rows(spark, str(tmp_path / "g.json"), [-1, 5]).collect()] == [("x.tif", 5, 1.0, 2.0, 3.0, 4.0)]


def test_logs_and_uploads(spark, tmp_path):
    (tmp_path / "r.csv").write_text("  epoch,   loss\n   0,   0.5\n   1,   0.25\n")
    assert [tuple(r) for r in S.run_log(spark, str(tmp_path / "r.csv")).collect()] == [(0, 0.5), (1, 0.25)]
    (tmp_path / "n.txt").write_text(" 1  2.5\n")
    assert S.numeric_rows(spark, str(tmp_path / "n.txt")).first().values == [1.0, 2.5]
    rows = spark.createDataFrame([("a.PNG", b"x\xff\xd9"), ("a.txt", b"x"), ("b.jpg", b"")], "n string, c binary")
    assert [r[0] for r in rows.select(S.jpeg_ok(F.col("c"))).collect()] == [True, False, False]


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 0.5, "cat"), (1, 0, 0.25, "cat"), (1, 2, 0.9, "dog")], "image_id int, cls int, conf double, name string")
    assert S.summary_text(rows).first().said == "2 cats, 1 dog"
    scores = spark.createDataFrame([([0.1, 0.7, 0.2],)], "s array<double>")
    assert scores.select(S.top_text(F.col("s"), F.array(*map(F.lit, "abc")), 2)).first()[0] == "0.70 b\n0.20 c"


def test_polygons_and_boxes(spark):
    square = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)],)], "p array<struct<x:double,y:double>>")
    r = square.select(G.resampled(F.col("p"), 5).alias("r"), F.array(*G.polygon_box(F.col("p"), 3, 3)).alias("b")).first()
    assert [(q.x, q.y) for q in r.r] == [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)] and r.b == [0.0, 0.0, 0.0, 0.0]


def test_anchors(spark):
    sizes = spark.createDataFrame([(10.0 + i % 3, 20.0 + i % 2) for i in range(40)] + [(100.0 + i % 3, 80.0 + i % 2) for i in range(40)], "w double, h double")
    found = D.kmeans_anchors(sizes, 2, 20)
    assert D.anchor_fit(sizes, found).first().bpr == 1.0


def test_frames_stream(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    frames = events.select(F.col("user_id").alias("source_id"), "ts", F.col("event_id").alias("frame_no"), F.col("event_type").alias("label"))
    frames.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frames.schema).parquet(str(tmp_path / "in"))
    q = R.latest(R.every(stream, 2)).writeStream.format("memory").queryName("newest").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(spark.table("newest").collect()) == sorted(R.latest(R.every(frames, 2)).collect())
    R.to_folders(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == frames.count()


def test_resampled_builds_the_closed_polygon_once(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0)],), (None,)], "p array<struct<x:double,y:double>>").select(G.resampled(F.col("p"), 7).alias("r"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("concat(") == 1
    got = df.collect()
    assert [(p.x, p.y) for p in got[0].r] == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0), (0.0, 0.0)]
    assert [(p.x, p.y) for p in got[1].r] == [(None, None)] * 7
