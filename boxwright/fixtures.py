"""Detection tables derived from lineitem by integer arithmetic, the same in every engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]

#: The same tables in SQL, as common table expressions gt and det.
SQL = """
li AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
  l_extendedprice, l_quantity, l_discount, l_tax) AS INT) AS rn, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem),
gx AS (SELECT l_orderkey AS image_id, rn AS gt_id, CAST(l_partkey % 8 AS INT) AS cls, CAST((l_partkey * 37) % 500 AS INT) AS x1,
  CAST((l_suppkey * 53 + l_linenumber * 71) % 350 AS INT) AS y1, l_quantity, l_suppkey, cents FROM li),
gc AS (SELECT image_id, gt_id, cls, x1, y1, CAST(x1 + 20 + l_quantity * 2 AS INT) AS x2, CAST(y1 + 20 + (l_suppkey % 50) * 2 AS INT) AS y2, cents FROM gx),
gt AS (SELECT image_id, gt_id, cls, x1, y1, x2, y2 FROM gc),
det AS (SELECT image_id, gt_id * 2 AS det_id, CAST(CASE WHEN cents % 11 = 0 THEN (cls + 1) % 8 ELSE cls END AS INT) AS cls,
    CAST(x1 + cents % 13 - 6 AS INT) AS x1, CAST(y1 + cents % 17 - 8 AS INT) AS y1, CAST(x2 + cents % 7 - 3 AS INT) AS x2,
    CAST(y2 + cents % 19 - 9 AS INT) AS y2, CAST(cents % 997 AS DOUBLE) / 1000 AS conf FROM gc WHERE cents % 7 <> 0
  UNION ALL SELECT image_id, gt_id * 2 + 1, cls, CAST(x1 + cents % 29 AS INT), CAST(y1 + cents % 23 AS INT),
    CAST(x2 + cents % 29 AS INT), CAST(y2 + cents % 23 AS INT), CAST(cents % 499 AS DOUBLE) / 1000 FROM gc WHERE cents % 5 = 0)
"""


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ORDER))
    li = li.select(F.col("l_orderkey").alias("image_id"), rn.alias("gt_id"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    corner = li.withColumns({"cls": (F.col("l_partkey") % 8).cast("int"), "x1": (F.col("l_partkey") * 37 % 500).cast("int"), "y1": ((F.col("l_suppkey") * 53 + F.col("l_linenumber") * 71) % 350).cast("int")})
    return corner.select("image_id", "gt_id", "cls", "x1", "y1", (F.col("x1") + 20 + F.col("l_quantity") * 2).cast("int").alias("x2"), (F.col("y1") + 20 + F.col("l_suppkey") % 50 * 2).cast("int").alias("y2"), "cents")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, gt_id, cls, x1, y1, x2, y2"""
    return _labels(spark, sf_dir).drop("cents")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, det_id, cls, x1, y1, x2, y2, conf; both branches come from one scan of the labels."""
    c = F.col("cents")
    side = lambda name, a, b: (F.col(name) + a).cast("int") if b is None else (F.col(name) + a - b).cast("int")
    first = F.struct((F.col("gt_id") * 2).alias("det_id"), F.when(c % 11 == 0, (F.col("cls") + 1) % 8).otherwise(F.col("cls")).alias("cls"), side("x1", c % 13, 6).alias("x1"), side("y1", c % 17, 8).alias("y1"), side("x2", c % 7, 3).alias("x2"), side("y2", c % 19, 9).alias("y2"), ((c % 997).cast("double") / 1000).alias("conf"))
    second = F.struct((F.col("gt_id") * 2 + 1).alias("det_id"), F.col("cls").alias("cls"), side("x1", c % 29, None).alias("x1"), side("y1", c % 23, None).alias("y1"), side("x2", c % 29, None).alias("x2"), side("y2", c % 23, None).alias("y2"), ((c % 499).cast("double") / 1000).alias("conf"))
    both = F.filter(F.array(F.when(c % 7 != 0, first), F.when(c % 5 == 0, second)), lambda d: d.isNotNull())
    return _labels(spark, sf_dir).select("image_id", F.explode(both).alias("d")).select("image_id", "d.*")
