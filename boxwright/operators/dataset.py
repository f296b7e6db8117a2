"""Dataset checks, statistics, weights, splits, batches, anchors and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxwright.functions import geometry as G


def label_status(rows: DataFrame, classes: int) -> DataFrame:
    """Adds status to label rows (cls, x, y, w, h): ok, missing, negative, outside or class."""
    box = ("x", "y", "w", "h")
    null = F.lit(False)
    for c in ("cls", *box):
        null = null | F.col(c).isNull()
    low, high = F.least("cls", *box) < 0, F.greatest(*box) > 1
    return rows.withColumn("status", F.when(null, "missing").when(low, "negative").when(high, "outside").when(F.col("cls") >= classes, "class").otherwise("ok"))


def distinct_labels(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates(["image_id", "cls", "x1", "y1", "x2", "y2"])


def images_with(rows: DataFrame, least: int) -> DataFrame:
    """image_id, n of the images with at least so many labels."""
    return rows.groupBy("image_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def statistics(gt: DataFrame, images: DataFrame) -> DataFrame:
    """Per split, and per split and class, instances and images; cls is null in a split's total, which also counts images without labels."""
    rows = images.join(gt, "image_id", "left")
    by = rows.groupingSets([["split"], ["split", "cls"]], "split", "cls")
    out = by.agg(F.grouping("cls").alias("total"), F.count("gt_id").alias("instances"), F.countDistinct(F.when(F.col("gt_id").isNotNull(), F.col("image_id"))).alias("labelled"), F.countDistinct(F.when(F.col("gt_id").isNull(), F.col("image_id"))).alias("unlabelled"))
    return out.where((F.col("total") == 1) | F.col("cls").isNotNull())


def class_histogram(gt: DataFrame, classes: DataFrame) -> DataFrame:
    """cls, n for every class of the dimension, zeros included."""
    return classes.join(gt.groupBy("cls").agg(F.count("*").alias("n")), "cls", "left").select("cls", F.coalesce("n", F.lit(0)).alias("n"))


def class_weights(gt: DataFrame, classes: DataFrame) -> DataFrame:
    """cls, weight: inverse counts (an absent class counts 1), summing to 1."""
    inverse = class_histogram(gt, classes).select("cls", (1 / F.greatest("n", F.lit(1))).alias("inv"))
    return inverse.select("cls", (F.col("inv") / F.sum("inv").over(Window.partitionBy(F.lit(0)))).alias("weight"))


def image_weights(gt: DataFrame, weights: DataFrame) -> DataFrame:
    """image_id, weight: sum of its labels' class weights."""
    return gt.groupBy("image_id", "cls").agg(F.count("*").alias("n")).join(weights, "cls").groupBy("image_id").agg(F.sum(F.col("n") * F.col("weight")).alias("weight"))


def hash_split(key: Column, train: float = 0.9, val: float = 0.1) -> Column:
    """train, val or test by a stable hash of the key: the same for any partitioning and engine."""
    x = F.conv(F.substring(F.md5(key.cast("string")), 1, 6), 16, 10).cast("long") % 1000
    return F.when(x < train * 1000, "train").when(x < (train + val) * 1000, "val").otherwise("test")


def rect_batches(images: DataFrame, size: int) -> DataFrame:
    """batch, n, least and most of images in aspect order, so that a batch needs little padding.

    Images of one aspect are counted first, so however many there are, they are one row; an aspect then fills the batches
    that its places reach into. Places are summed in two levels, over ranges of aspects and within a range.
    """
    rows = images.groupBy("aspect").agg(F.count("*").alias("c")).withColumn("b", F.floor(F.col("aspect") * 256))
    within = Window.partitionBy("b").orderBy("aspect").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("c").over(within))
    before = Window.partitionBy(F.lit(0)).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offs = rows.groupBy("b").agg(F.max("upto").alias("n")).select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    placed = rows.join(offs, "b").withColumn("end", F.col("off") + F.col("upto")).withColumn("start", F.col("end") - F.col("c"))
    spread = placed.withColumn("batch", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))))
    share = F.least("end", (F.col("batch") + 1) * size) - F.greatest("start", F.col("batch") * size)
    return spread.groupBy("batch").agg(F.sum(share).alias("n"), F.min("aspect").alias("least"), F.max("aspect").alias("most"))


def batch_shapes(batches: DataFrame, size: int, stride: int = 32, pad: float = 0.0) -> DataFrame:
    """Adds height and width of each batch from its least and most aspect (height / width): the longer side is ``size``."""
    tall, wide = F.when(F.col("least") > 1, 1 / F.col("least")).otherwise(1.0), F.when(F.col("most") < 1, F.col("most")).otherwise(1.0)
    fit = lambda x: (F.ceil(x * size / stride + pad) * stride).cast("int")
    return batches.withColumns({"height": fit(wide), "width": fit(tall)})


def density(rows: DataFrame, x: str, y: str, bins_x: float, bins_y: float) -> DataFrame:
    """bx, by, n, log_n of a two-dimensional histogram with cells of the given widths."""
    cells = rows.select(F.floor(F.col(x) / bins_x).alias("bx"), F.floor(F.col(y) / bins_y).alias("by"))
    return cells.groupBy("bx", "by").agg(F.count("*").alias("n")).withColumn("log_n", F.log("n"))


def line_fit(rows: DataFrame, x: str, y: str) -> DataFrame:
    """slope and intercept of the least-squares line."""
    return rows.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def file_digest(files: DataFrame) -> DataFrame:
    """total, digest of files (path, size): sha256 over the total size and the digests of 256 groups of paths, in order.

    A group holds the paths whose md5 starts with its two digits, and its digest is that of its sorted paths; so no list
    of all paths is built. Equal file sets have equal digests, in any order.
    """
    group = files.groupBy(F.substring(F.md5(F.col("path")), 1, 2).alias("g")).agg(F.sum("size").alias("size"), F.sha2(F.array_join(F.sort_array(F.collect_list("path")), ""), 256).alias("h"))
    parts = group.agg(F.sum("size").alias("total"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("g", "h"))), lambda x: x["h"]), "").alias("h"))
    return parts.select("total", F.sha2(F.concat(F.col("total").cast("string"), "h"), 256).alias("digest"))


def annotated_split(images: DataFrame, labelled: DataFrame, key: str) -> DataFrame:
    """key, split of the images that have a label file: others are left out of every split."""
    return images.join(labelled.select(key).distinct(), key, "left_semi").select(key, hash_split(F.col(key)).alias("split"))


# anchors


def anchor_array(anchors: list[tuple[float, float]]) -> Column:
    return F.array(*[F.struct(F.lit(float(w)).alias("w"), F.lit(float(h)).alias("h")) for w, h in anchors])


def fit_ratio(w: Column, h: Column, a: Column) -> Column:
    """Least of both sides' ratios to the anchor, and of their inverses: 1 is a perfect fit."""
    rw, rh = w / a["w"], h / a["h"]
    return F.least(rw, 1 / rw, rh, 1 / rh)


def anchor_fit(labels: DataFrame, anchors: list[tuple[float, float]], limit: float = 4.0) -> DataFrame:
    """bpr (labels with a fitting anchor), aat (fitting anchors a label), fitness (mean best ratio where it fits)."""
    ratios = F.transform(anchor_array(anchors), lambda a: fit_ratio(F.col("w"), F.col("h"), a))
    best, fits = F.array_max("r"), F.size(F.filter("r", lambda r: r > 1 / limit))
    return labels.withColumn("r", ratios).agg(F.avg((best > 1 / limit).cast("double")).alias("bpr"), F.avg(fits.cast("double")).alias("aat"), F.avg(best * (best > 1 / limit).cast("double")).alias("fitness"))


def assign(targets: DataFrame, anchors: list[tuple[float, float]], grid: int, limit: float = 4.0, bias: float = 0.5) -> DataFrame:
    """Targets (x, y, w, h in grid cells) to rows of anchor, gx, gy: all anchors within the ratio, in the own cell and the neighbours nearer than bias."""
    fits = F.filter(F.transform(anchor_array(anchors), lambda a, i: F.struct(i.alias("anchor"), fit_ratio(F.col("w"), F.col("h"), a).alias("r"))), lambda s: 1 / s["r"] < limit)
    frac = lambda c: c - F.floor(c)
    x, y = F.col("x"), F.col("y")
    spots = [(F.lit(True), 0.0, 0.0), ((frac(x) < bias) & (x > 1), -bias, 0.0), ((frac(y) < bias) & (y > 1), 0.0, -bias), ((frac(grid - x) < bias) & (grid - x > 1), bias, 0.0), ((frac(grid - y) < bias) & (grid - y > 1), 0.0, bias)]
    cells = F.filter(F.array(*[F.when(ok, F.struct(G.clamp(F.floor(x + dx), 0, grid - 1).cast("int").alias("gx"), G.clamp(F.floor(y + dy), 0, grid - 1).cast("int").alias("gy"))) for ok, dx, dy in spots]), lambda c: c.isNotNull())
    return targets.select("*", F.explode(fits).alias("f")).select("*", F.explode(cells).alias("c")).select(*targets.columns, "f.anchor", "c.gx", "c.gy")


def kmeans_anchors(labels: DataFrame, n: int = 9, steps: int = 200, seed: int = 0) -> list[tuple[float, float]]:
    """Anchors by k-means on whitened sizes, then a mutation hill climb on the mean fit; only n pairs reach the driver."""
    import numpy as np
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    sd = labels.agg(F.stddev_pop("w").alias("w"), F.stddev_pop("h").alias("h")).first()
    sw, sh = (x if x else 1.0 for x in (sd.w, sd.h))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(labels.select((F.col("w") / sw).alias("a"), (F.col("h") / sh).alias("b")))
    best = [(float(c[0] * sw), float(c[1] * sh)) for c in KMeans(k=n, seed=seed, maxIter=30).fit(rows).clusterCenters()]
    # the climb scores on a bounded histogram of sizes: log-spaced cells of a 32nd of an octave
    cells = labels.where("w > 0 AND h > 0").groupBy(F.round(F.log2("w") * 32).alias("lw"), F.round(F.log2("h") * 32).alias("lh")).agg(F.count("*").alias("n"))
    data = np.array([(2 ** (r.lw / 32), 2 ** (r.lh / 32), r.n) for r in cells.collect()]) if best else np.zeros((0, 3))
    rng = np.random.default_rng(seed)

    def score(a):
        r = data[:, None, :2] / np.array(a)[None]
        m = np.minimum(r, 1 / r).min(2).max(1)
        return float((m * (m > 0.25) * data[:, 2]).sum() / data[:, 2].sum())

    # climb: one anchor at a time is stretched along a random axis; steps shrink while they fail and grow when they help
    top, reach = score(best) if len(data) else 0.0, 0.2
    for step in range(steps if len(data) else 0):
        trial, k = list(best), step % n
        angle = rng.uniform(0, 2 * np.pi)
        trial[k] = tuple(max(2.0, v * float(np.exp(reach * t))) for v, t in zip(best[k], (np.cos(angle), np.sin(angle)), strict=True))
        if (s := score(trial)) > top:
            best, top, reach = trial, s, min(0.5, reach * 1.5)
        else:
            reach = max(0.01, reach * 0.97)
    return sorted(best, key=lambda a: a[0] * a[1])


# run logs: run_id, epoch and metrics


def fitness(weights: dict[str, float]) -> Column:
    out = F.lit(0.0)
    for c, w in weights.items():
        out = out + F.col(c) * w
    return out


def early_stop(runs: DataFrame, patience: int, order: str = "epoch") -> DataFrame:
    """Adds best (running maximum of fit), best_epoch (latest that reached it) and stop (patience is used up)."""
    w = Window.partitionBy("run_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = runs.withColumn("best", F.max("fit").over(w))
    out = out.withColumn("best_epoch", F.max(F.when(F.col("fit") >= F.col("best"), F.col(order))).over(w))
    return out.withColumn("stop", F.col(order) - F.col("best_epoch") >= patience)


def running_best(runs: DataFrame, value: str, order: str = "epoch") -> DataFrame:
    """Adds best, the largest value so far."""
    w = Window.partitionBy("run_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return runs.withColumn("best", F.max(value).over(w))


def running_mean(runs: DataFrame, value: str, order: str = "epoch") -> DataFrame:
    w = Window.partitionBy("run_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return runs.withColumn("mean", F.avg(value).over(w))


def ramped_average(runs: DataFrame, value: str, decay: float = 0.9999, tau: float = 2000, order: str = "epoch") -> DataFrame:
    """run_id, ema: exponential average whose decay ramps up as decay * (1 - exp(-k / tau)); sequential, so folded in one row a run."""
    rows = runs.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct(order, F.col(value).cast("double").alias("v")))).alias("xs"))
    start = F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("e"))

    def step(s: Column, x: Column) -> Column:
        d = decay * (1 - F.exp(-(s["k"] + 1) / F.lit(float(tau))))
        return F.struct((s["k"] + 1).alias("k"), (s["e"] * d + x["v"] * (1 - d)).alias("e"))

    return rows.select("run_id", F.aggregate("xs", start, step, lambda s: s["e"]).alias("ema"))
