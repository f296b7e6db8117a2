"""Sinks of run logs and dataset statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_log(rows: DataFrame, path: str, form: str = "json") -> None:
    """Adds rows (epochs or generations) to a log folder: form json gives a JSON line a row, csv a header in each file."""
    rows.write.mode("append").format(form).option("header", True).save(path)


def follow_log(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Adds a stream's available rows to a log folder; the checkpoint keeps a restart from writing a row twice."""
    return rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stats_json(stats: DataFrame) -> DataFrame:
    """split, json of rows (split, cls, instances, labelled, unlabelled); cls is null in a split's total. Classes ascend."""
    per_class = F.sort_array(F.collect_list(F.when(F.col("cls").isNotNull(), F.struct("cls", "instances", "labelled"))))
    total = F.max(F.when(F.col("cls").isNull(), F.struct("instances", "labelled", "unlabelled")))
    return stats.groupBy("split").agg(total.alias("total"), per_class.alias("per_class")).select("split", F.to_json(F.struct("total", "per_class")).alias("json"))
