"""Folders that the driver and all executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; only where that is unset, in a local run, below a temporary folder.

    Executors of a cluster do not share the driver's folders, so there the setting must be given.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.conf.get("boxwright.shared.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="boxwright-")
        spark.conf.set("boxwright.shared.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, and survives a lost executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Deletes the table that written() made, once nothing reads it any more."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Bytes of rows that go to a Python worker at once, where the session keeps Spark's own default of 64 MB.
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table; from then on the session bounds batches for Python workers by bytes, so that long texts do not pile up."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == f"{64 << 20}b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def split_points(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most parts - 1 values that deal the column's rows out evenly in ascending order (parts bounds the driver's list)."""
    if parts < 2:
        return []
    at = [k / parts for k in range(1, parts)]
    return sorted({int(x) for x in df.stat.approxQuantile(column, at, 0.2 / parts)})


def part_of(column: Column, points: list[int]) -> Column:
    """Number of points that are <= the column, searched in two levels; null counts as the first part."""
    if not points:
        return F.lit(0)
    step = max(1, round(len(points) ** 0.5))
    blocks = [points[k : k + step] for k in range(0, len(points), step)]
    heads = F.array(*[F.lit(b[0]) for b in blocks])
    below = F.size(F.filter(heads, lambda x: x <= column))
    lists = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    within = F.size(F.filter(F.element_at(lists, F.greatest(below, F.lit(1))), lambda x: x <= column))
    return F.when(column.isNull() | (below == 0), F.lit(0)).otherwise((below - 1) * step + within).cast("int")
