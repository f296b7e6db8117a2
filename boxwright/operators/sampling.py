"""Reproducible orders, shards, partners and weighted draws: hashes of keys stand for random numbers, in any engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = 1 << 12  # hashes in one range: 4096 ranges of a 24-bit hash


def uniform(seed: str, key: Column, digits: int = 6) -> Column:
    """Leading hexadecimal digits of md5(seed-key) as a number."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string"))), 1, digits), 16, 10).cast("long")


def dealt(rows: DataFrame, key: str, seed: str, weight: Column | None = None) -> DataFrame:
    """Adds idx, the weight of all rows before this one in the order of hash and key (weight 1: its place from 0).

    Ranges of the hash are summed first, so a global order needs one window over 4096 range totals and one in each range.
    """
    rows = rows.withColumn("__h", uniform(seed, F.col(key))).withColumn("__w", F.lit(1).cast("long") if weight is None else weight.cast("long"))
    rows = rows.withColumn("__b", F.floor(F.col("__h") / _BUCKET))
    before = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offs = rows.groupBy("__b").agg(F.sum("__w").alias("s")).select("__b", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("__off"))
    within = F.coalesce(F.sum("__w").over(Window.partitionBy("__b").orderBy("__h", key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("idx", within).join(offs, "__b").withColumn("idx", F.col("idx") + F.col("__off")).drop("__h", "__w", "__b", "__off")


def shards(rows: DataFrame, key: str, world: int, seed: str = "shard") -> DataFrame:
    """key, shard: every shard has as many rows; the first ones in hash order are given twice to fill the last round."""
    order = dealt(rows.select(key), key, seed)
    total = order.agg(F.count("*").alias("n"))
    places = F.filter(F.array("idx", F.when(F.col("idx") < F.pmod(-F.col("n"), F.lit(world)), F.col("n") + F.col("idx"))), lambda i: i.isNotNull())
    return order.crossJoin(F.broadcast(total)).select(key, F.explode(places).alias("i")).select(key, (F.col("i") % world).alias("shard"))


def partners(rows: DataFrame, key: str, slots: int, seed: str = "partner") -> DataFrame:
    """key, slot, partner: a row drawn with replacement for each slot of each row."""
    order = dealt(rows.select(key), key, seed)
    total = order.agg(F.count("*").alias("n"))
    draws = rows.select(key, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")).crossJoin(F.broadcast(total))
    draws = draws.withColumn("idx", uniform(seed, F.concat(F.col(key).cast("string"), F.lit("-"), F.col("slot").cast("string")), 12) % F.col("n"))
    return draws.join(order.select("idx", F.col(key).alias("partner")), "idx").select(key, "slot", "partner")


def weighted_draws(rows: DataFrame, key: str, weight: str, draws: int, seed: str = "draw", parts: int = 1 << 16) -> DataFrame:
    """draw, key: draws with replacement in proportion to whole-number weights; no rows, no draws.

    A row owns an interval of the summed weights; intervals and draws meet by an equi-join on ``parts`` equal stretches,
    so a heavy row is spread over many and adds at most ``parts`` rows.
    """
    owned = dealt(rows.where(F.col(weight) > 0).select(key, weight), key, seed, F.col(weight)).withColumn("end", F.col("idx") + F.col(weight))
    total = F.broadcast(owned.agg(F.max("end").alias("total")))

    def stretch(at: Column) -> Column:
        return F.floor(at.cast("double") / F.col("total") * parts).cast("long")

    owned = owned.crossJoin(total).withColumn("part", F.explode(F.sequence(stretch(F.col("idx")), stretch(F.col("end") - 1))))
    drawn = rows.sparkSession.range(draws).withColumnRenamed("id", "draw").crossJoin(total).where("total IS NOT NULL")
    drawn = drawn.withColumn("at", uniform(seed, F.col("draw"), 12) % F.col("total")).withColumn("part", stretch(F.col("at"))).drop("total")
    return drawn.join(owned, "part").where((F.col("at") >= F.col("idx")) & (F.col("at") < F.col("end"))).select("draw", key)
