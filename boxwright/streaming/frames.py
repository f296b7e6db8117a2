"""Frame streams: rows of source_id, ts, frame_no, label. Functions take batch or streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def every(frames: DataFrame, stride: int) -> DataFrame:
    """Each stride-th frame."""
    return frames.where(F.col("frame_no") % stride == 0)


def latest(frames: DataFrame) -> DataFrame:
    """source_id, frame_no, label of each source's newest frame (update mode on a stream): older frames are overwritten."""
    newest = F.max(F.struct("ts", "frame_no", "label"))
    return frames.groupBy("source_id").agg(newest.alias("f")).select("source_id", "f.frame_no", "f.label")


def counts(frames: DataFrame) -> DataFrame:
    return frames.groupBy("source_id", "label").agg(F.count("*").alias("n"))


def with_fallback(frames: DataFrame, rate: float = 30.0) -> DataFrame:
    """fps: the source's own, or the fallback where it is null, not a number or 0; a lost payload is empty."""
    out = frames.withColumn("fps", F.coalesce(F.nullif(F.nanvl(F.col("fps"), F.lit(0.0)), F.lit(0.0)), F.lit(rate)))
    return out.withColumn("payload", F.coalesce("payload", F.to_binary(F.lit(""), F.lit("utf-8")))) if "payload" in out.columns else out


# extensions: event-time windows


def tumbling(frames: DataFrame, width: str, late: str | None = None) -> DataFrame:
    rows = frames.withWatermark("ts", late) if late else frames
    return rows.groupBy(F.window("ts", width).alias("w"), "label").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "label", "n")


def sessions(frames: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    rows = frames.withWatermark("ts", late) if late else frames
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "source_id").agg(F.count("*").alias("n")).select("source_id", F.col("w.start").alias("start"), "n")


def distinct_frames(frames: DataFrame, late: str) -> DataFrame:
    return frames.withWatermark("ts", late).dropDuplicatesWithinWatermark(["source_id", "frame_no"])


def to_folders(frames: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch to a folder a source, so the output switches where the source does."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("append").partitionBy("source_id").parquet(folder)

    return frames.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
