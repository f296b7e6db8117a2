"""Choices among boxes: second-stage agreement, padded results, target rows, small boxes, free places for pasting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxwright.functions import geometry as G


def agreeing(det: DataFrame, second: DataFrame) -> DataFrame:
    """Detections whose class a second classifier (image_id, det_id, cls) confirms."""
    return det.join(second.select("image_id", "det_id", "cls"), ["image_id", "det_id", "cls"], "left_semi")


def padded_top(det: DataFrame, per_class: int, overall: int) -> DataFrame:
    """image_id, slot, cls, conf, valid: the best of each class, the best of those, and empty slots (cls -1, conf 0) to a fixed width."""
    best = F.row_number().over(Window.partitionBy("image_id", "cls").orderBy(F.desc("conf"), "det_id"))
    kept = det.withColumn("k", best).where(F.col("k") <= per_class)
    rows = kept.groupBy("image_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("conf")).alias("neg"), "det_id", "cls", "conf"))), 1, overall).alias("top"))
    rows = rows.select("image_id", "top", F.explode(F.sequence(F.lit(0), F.lit(overall - 1))).alias("slot")).withColumn("b", F.get("top", F.col("slot")))
    return rows.select("image_id", "slot", F.coalesce("b.cls", F.lit(-1)).alias("cls"), F.coalesce("b.conf", F.lit(0.0)).alias("conf"), F.col("b").isNotNull().alias("valid"))


def target_rows(det: DataFrame, limit: int) -> DataFrame:
    """image_id, det_id, cls, x, y, w, h, conf of the best detections of each image."""
    k = F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("conf"), "det_id"))
    centre = [c.alias(n) for n, c in zip("xywh", G.to_center(G.columns()), strict=True)]
    return det.withColumn("k", k).where(F.col("k") <= limit).select("image_id", "det_id", "cls", *centre, "conf")


def smallest_half(boxes: DataFrame, obj: str) -> DataFrame:
    """The smaller half of each image's boxes by area; a half box is rounded to even."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    w = Window.partitionBy("image_id")
    ranked = boxes.withColumns({"__k": F.row_number().over(w.orderBy(area, obj)), "__n": F.count("*").over(w)})
    return ranked.where(F.col("__k") <= F.bround(F.col("__n") * 0.5, 0)).drop("__k", "__n")


def pasteable(boxes: DataFrame, obj: str, width: int, limit: float = 0.3) -> DataFrame:
    """Boxes with their mirrored corners, where the mirror image covers less than the limit of every box of the image."""
    mirror = boxes.select("image_id", F.col(obj).alias("__o"), (width - F.col("x2")).alias("m_x1"), F.col("y1").alias("m_y1"), (width - F.col("x1")).alias("m_x2"), F.col("y2").alias("m_y2"))
    hidden = mirror.join(boxes, "image_id").where(G.ioa(G.columns("m_"), G.columns()) >= limit).select("image_id", "__o").distinct()
    return mirror.join(hidden, ["image_id", "__o"], "left_anti").withColumnRenamed("__o", obj)
