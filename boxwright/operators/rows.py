"""Rows of images, labels and detections: unions, gates, links to files, summaries, defaults and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxwright.functions import geometry as G
from boxwright.operators.sampling import uniform

CORNERS = ("x1", "y1", "x2", "y2")


def with_known(det: DataFrame, known: DataFrame, obj: str) -> DataFrame:
    """Detections and known labels of the same images, these with confidence 1: image_id, source, det_id, cls, corners, conf."""
    columns = ["image_id", "source", "det_id", "cls", *CORNERS, "conf"]
    found = det.withColumn("source", F.lit("found")).select(columns)
    return found.unionByName(known.withColumns({"source": F.lit("known"), "det_id": F.col(obj), "conf": F.lit(1.0)}).select(columns))


def only_classes(rows: DataFrame, classes: list[int] | None, single: bool = False) -> DataFrame:
    """Rows of the listed classes (no list: all), as class 0 if ``single``. A row brings its points along, so they stay aligned."""
    kept = rows if not classes else rows.where(F.col("cls").isin(classes))
    return kept.withColumn("cls", F.lit(0)) if single else kept


def sized(rows: DataFrame, w: Column, h: Column, small: float = 3.0, least: float = 2.0) -> DataFrame:
    """Adds small (a side below ``small`` pixels) and usable (a side of ``least`` pixels or more)."""
    return rows.withColumns({"small": (w < small) | (h < small), "usable": (w >= least) | (h >= least)})


def common_keys(a: DataFrame, b: DataFrame, key: str, shape: str) -> DataFrame:
    """Rows of a whose key is in b with an equal shape (null shapes are equal)."""
    other = b.select(F.col(key).alias("other_key"), F.col(shape).alias("other_shape")).distinct()
    return a.join(other, (F.col(key) == F.col("other_key")) & F.col(shape).eqNullSafe(F.col("other_shape")), "left_semi")


def image_status(rows: DataFrame, formats: list[str], least: int = 10) -> DataFrame:
    """Adds status to images (width, height, format): ok, unreadable, size or format."""
    tiny = (F.col("width") < least) | (F.col("height") < least)
    unread = F.col("width").isNull() | F.col("height").isNull() | F.col("format").isNull()
    return rows.withColumn("status", F.when(unread, "unreadable").when(tiny, "size").when(~F.lower("format").isin(formats), "format").otherwise("ok"))


def image_labels(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Every image (label_path) with its label rows (path, status), or one row without: a missing label file is background."""
    return images.join(labels.withColumnRenamed("path", "label_path"), "label_path", "left")


def scan_summary(joined: DataFrame, by: str = "path") -> DataFrame:
    """missing, found, empty, corrupt, images from image_labels(): an image with a bad row is corrupt and counts as nothing else.

    status is null where there is no label file, 'empty' for a file without rows, 'ok' or the fault of a row.
    """
    bad = F.bool_or(F.coalesce(~F.col("status").isin("ok", "empty"), F.lit(False)))
    each = joined.groupBy(by).agg(bad.alias("corrupt"), F.bool_or(F.col("status") == "empty").alias("empty"), F.count("status").alias("n"))
    fine = ~F.col("corrupt")
    return each.agg(*(F.count_if(c).alias(n) for n, c in (("missing", fine & (F.col("n") == 0)), ("found", fine & (F.col("n") > 0)), ("empty", fine & F.coalesce("empty", F.lit(False))), ("corrupt", F.col("corrupt")), ("images", F.lit(True)))))


def duplicate_counts(rows: DataFrame, image: str = "image_id") -> DataFrame:
    """image, removed, message of the images that hold equal label rows."""
    each = rows.groupBy(image, "cls", *CORNERS).agg((F.count("*") - 1).alias("more")).where("more > 0")
    out = each.groupBy(image).agg(F.sum("more").alias("removed"))
    return out.withColumn("message", F.format_string("%s: %d duplicate labels removed", F.col(image).cast("string"), F.col("removed")))


def absent_paths(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Paths that are asked for and not there."""
    return wanted.join(present.select("path").distinct(), "path", "left_anti")


def ensemble(members: list[DataFrame]) -> DataFrame:
    """All members' rows with the member's number: suppression over them together is the vote of the ensemble."""
    out = None
    for k, m in enumerate(members):
        rows = m.withColumn("member", F.lit(k))
        out = rows if out is None else out.unionByName(rows)
    return out


def same_shape(frames: DataFrame, *columns: str) -> DataFrame:
    """shapes (how many different ones; rows with a null are none of them) and same (at most one)."""
    return frames.agg(F.count_distinct(*columns).alias("shapes")).withColumn("same", F.col("shapes") <= 1)


# metrics


def counts_from_rates(rates: DataFrame) -> DataFrame:
    """Adds tp and fp, half to even, to rows of precision, recall and n_labels."""
    tp = F.bround(F.col("recall") * F.col("n_labels"), 0)
    fp = F.bround(tp / (F.col("precision") + 1e-16) - tp, 0)
    return rates.withColumns({"tp": tp.cast("long"), "fp": fp.cast("long")})


def refreshed_weights(weights: DataFrame, maps: DataFrame) -> DataFrame:
    """cls, weight: class weights times (1 - map) squared, map being 0 where a class has none: hard classes are drawn more."""
    short = 1 - F.coalesce("map", F.lit(0.0))
    return weights.join(maps.select("cls", "map"), "cls", "left").select("cls", (F.col("weight") * short * short).alias("weight"))


def class_maps(ap: DataFrame, classes: DataFrame) -> DataFrame:
    """cls, map of every class: its mean over thresholds, and the overall mean for a class that was not judged."""
    each = ap.groupBy("cls").agg(F.avg("ap").alias("map"))
    overall = each.agg(F.avg("map").alias("overall"))
    return classes.join(each, "cls", "left").crossJoin(F.broadcast(overall)).select("cls", F.coalesce("map", "overall").alias("map"))


#: Weights of precision, recall, map50 and map in a fitness.
FITNESS = {"precision": 0.0, "recall": 0.0, "map50": 0.1, "map": 0.9}


def joint_fitness(kinds: tuple[str, ...] = ("box", "mask")) -> Column:
    """Sum of the fitness of each kind, from columns such as box_map50."""
    out = F.lit(0.0)
    for kind in kinds:
        for c, w in FITNESS.items():
            out = out + F.col(f"{kind}_{c}") * w
    return out


def stage_speed(times: DataFrame, images: Column) -> DataFrame:
    """stage, ms_per_image of rows (stage, ms), where ``images`` counts the images of a stage."""
    return times.groupBy("stage").agg((F.sum("ms") / images).alias("ms_per_image"))


def label_histograms(rows: DataFrame, bins: int = 50) -> DataFrame:
    """axis, bin, n of normalised centre boxes' x, y, w and h (1 falls in the last bin)."""
    axes = F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).alias("v")) for c in "xywh"])
    long = rows.select(F.explode(axes).alias("a")).select("a.axis", F.least(F.floor(F.col("a.v") * bins), F.lit(bins - 1)).alias("bin"))
    return long.groupBy("axis", "bin").agg(F.count("*").alias("n"))


def cache_need(images: DataFrame, size: int, sample: int = 30, margin: float = 0.1, seed: str = "ram") -> DataFrame:
    """images, needed: bytes to hold all frames (width, height, three channels) resized so that their longer side is ``size``.

    The mean of ``sample`` images, the first in hash order, is carried on to all; needed includes the margin.
    """
    some = images.orderBy(uniform(seed, F.col("image_id")), "image_id").limit(sample)
    ratio = size / F.greatest("width", "height")
    mean = some.agg(F.avg(F.col("width") * F.col("height") * 3 * ratio * ratio).alias("mean"))
    return images.agg(F.count("*").alias("images")).crossJoin(F.broadcast(mean)).select("images", (F.col("mean") * F.col("images") * (1 + margin)).alias("needed"))


def matched_log(pairs: DataFrame, conf: float = 0.25, limit: float = 0.45) -> DataFrame:
    """Confident pairs that overlap, as two records each: the label (score 100) and the detection (score in per cent)."""
    rows = pairs.where((F.col("conf") > conf) & (F.col("iou") > limit))
    record = lambda kind, cls, score, p: F.struct(F.lit(kind).alias("kind"), F.col(cls).alias("cls"), score.alias("score"), *(F.col(f"{p}{c}").alias(c) for c in CORNERS))
    both = F.array(record("label", "gt_cls", F.lit(100.0), "g_"), record("found", "cls", F.col("conf") * 100, ""))
    return rows.select("image_id", "det_id", "gt_id", F.explode(both).alias("r")).select("image_id", "det_id", "gt_id", "r.*")


# augmentation of labels


def holes(images: DataFrame, w: int, h: int, seed: str = "hole") -> DataFrame:
    """image_id, x1, y1, x2, y2 of rectangles to blank out, by hashes of the image: 1, 2, 4, 8 of up to a half, quarter, 8th, 16th side.

    The 16 smallest ones of the scheme (a 32nd of a side) hide no label and are left out.
    """
    plan = [(s, k) for s, n in ((0.5, 1), (0.25, 2), (0.125, 4), (0.0625, 8)) for k in range(n)]
    spots = F.array(*[F.struct(F.lit(float(s)).alias("s"), F.lit(f"{s}-{k}").alias("k")) for s, k in plan])
    rows = images.select("image_id", F.explode(spots).alias("p")).select("image_id", "p.s", F.concat(F.col("image_id").cast("string"), F.lit("-"), "p.k").alias("key"))

    def draw(name: str, top: Column) -> Column:
        return uniform(f"{seed}-{name}", F.col("key")) % top

    wide, high = (1 + draw(n, F.greatest(F.lit(1), F.floor(F.col("s") * side))) for n, side in (("w", w), ("h", h)))
    x1, y1 = (F.greatest(F.lit(0), draw(n, F.lit(side + 1)) - F.floor(m / 2)) for n, side, m in (("x", w, wide), ("y", h, high)))
    return rows.select("image_id", x1.alias("x1"), y1.alias("y1"), F.least(F.lit(w), x1 + wide).alias("x2"), F.least(F.lit(h), y1 + high).alias("y2"))


def uncovered(labels: DataFrame, blanks: DataFrame, obj: str, limit: float = 0.6) -> DataFrame:
    """Labels of which every single blank of their image covers less than the limit."""
    b = blanks.select("image_id", *(F.col(c).alias(f"b_{c}") for c in CORNERS))
    hidden = labels.join(b, "image_id").where(G.ioa(G.columns("b_"), G.columns()) >= limit).select("image_id", obj).distinct()
    return labels.join(hidden, ["image_id", obj], "left_anti")


def replicated(boxes: DataFrame, obj: str, w: int, h: int, seed: str = "copy") -> DataFrame:
    """Copies of boxes at places drawn by hashes, inside the frame: obj, the copy's corners."""
    key = F.concat(F.col("image_id").cast("string"), F.lit("-"), F.col(obj).cast("string"))
    wide, high = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    x, y = (uniform(f"{seed}-{n}", key) % F.greatest(F.lit(1), side - m) for n, side, m in (("x", w, wide), ("y", h, high)))
    return boxes.select("image_id", obj, "cls", x.alias("x1"), y.alias("y1"), (x + wide).alias("x2"), (y + high).alias("y2"))


def mixed(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """Labels of both images of each pair (image_id, partner), under the first's image_id: blended frames keep all boxes."""
    sides = pairs.select("image_id", F.explode(F.array("image_id", "partner")).alias("source"))
    return sides.join(labels.withColumnRenamed("image_id", "source"), "source")


def nine_tiles(tiles: DataFrame, side: float) -> DataFrame:
    """Adds left and top of each tile on the canvas to rows of mosaic, tile (0..8), w, h; a mosaic is one small group."""
    w = Window.partitionBy("mosaic").orderBy("tile")
    first = [F.first(c).over(w) for c in ("w", "h")]
    before = [F.coalesce(F.lag(c).over(w), F.lit(-1)) for c in ("w", "h")]
    left, top = G.nine_origin(F.col("tile"), side, F.col("w"), F.col("h"), *first, *before)
    return tiles.withColumns({"left": left, "top": top})


# anchors


def anchors_by_area(anchors: DataFrame) -> DataFrame:
    """Anchors (w, h) with rank from 0 by area; their number is that of a model's anchors."""
    return anchors.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("w") * F.col("h"), "w")) - 1)


def anchors_reversed(levels: DataFrame) -> DataFrame:
    """reversed: whether mean anchor areas fall where strides rise, of rows of level, stride, w, h (a row an anchor)."""
    each = levels.groupBy("level").agg(F.avg(F.col("w") * F.col("h")).alias("area"), F.first("stride").alias("stride"))
    ends = [F.max_by(c, "level") - F.min_by(c, "level") for c in ("area", "stride")]
    return each.agg(((ends[0] != 0) & (F.signum(ends[0]) != F.signum(ends[1]))).alias("reversed"))
