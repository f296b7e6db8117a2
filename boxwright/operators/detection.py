"""Matching, suppression and metrics of detections.

Labels: image_id, gt_id, cls, x1, y1, x2, y2. Detections: image_id, det_id, cls, corners, conf. Ties are ordered by
confidence descending, image_id, det_id; pairs by overlap descending, gt_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxwright.functions import geometry as G

#: The ten overlap thresholds.
THRESHOLDS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]
#: Cells of confidence for two-level running sums: a cell of a class is a window of its own.
BUCKETS = 1024


def cell(conf: Column) -> Column:
    """Cell of a confidence, from 0 for the highest; finer towards 0, where raw detections crowd."""
    low = F.lit(BUCKETS // 2) + F.least(F.floor(-F.log2(F.greatest(conf, F.lit(2.0**-60)) * 16) * (BUCKETS / 128)), F.lit(BUCKETS // 2 - 1))
    return F.when(conf >= 1 / 16, F.floor((1 - conf) * (BUCKETS / 2))).otherwise(low).cast("int")


def pairs(gt: DataFrame, det: DataFrame, same_class: bool = True) -> DataFrame:
    """All pairs of an image (and class), each with its overlap; the image is the join key, so a pair never crosses images."""
    g = gt.select("image_id", "gt_id", F.col("cls").alias("gt_cls"), *(F.col(c).alias(f"g_{c}") for c in ("x1", "y1", "x2", "y2")))
    both = det.join(g, "image_id")
    both = both.where(F.col("cls") == F.col("gt_cls")) if same_class else both
    return both.withColumn("iou", G.iou(G.columns("g_"), G.columns()))


def match(gt: DataFrame, det: DataFrame) -> DataFrame:
    """Best-label matches of boxes: see matched()."""
    return matched(pairs(gt, det))


def matched(near: DataFrame) -> DataFrame:
    """image_id, det_id, gt_id, conf, cls, iou, tp (an array with a flag for each threshold) of detections that reach the first.

    ``near`` holds pairs of equal class (of boxes, masks or whatever overlaps) with image_id, det_id, gt_id, cls, conf, iou.
    A detection competes for its best label only, the same at every threshold it reaches; the label goes to the most
    confident of its detections that reach the threshold. So overlaps are computed once and thresholds are no rows.
    """
    near = near.where(F.col("iou") >= THRESHOLDS[0])
    best = near.withColumn("k", F.row_number().over(Window.partitionBy("image_id", "det_id").orderBy(F.desc("iou"), "gt_id"))).where("k = 1")
    earlier = Window.partitionBy("image_id", "gt_id").orderBy(F.desc("conf"), "det_id").rowsBetween(Window.unboundedPreceding, -1)
    most = F.coalesce(F.max("iou").over(earlier), F.lit(-1.0))  # it is first at a threshold iff no earlier one reaches it
    flags = F.array(*[((F.col("iou") >= t) & (most < t)).cast("int") for t in THRESHOLDS])
    return best.select("image_id", "det_id", "gt_id", "conf", "cls", "iou", flags.alias("tp"))


def flagged(gt: DataFrame, det: DataFrame) -> DataFrame:
    """Every detection with its tp array (zeros if it has no match)."""
    return with_hits(det, match(gt, det))


def with_hits(det: DataFrame, hits: DataFrame) -> DataFrame:
    none = F.array(*[F.lit(0)] * len(THRESHOLDS))
    hit = hits.select("image_id", "det_id", "tp")
    return det.select("image_id", "det_id", "cls", "conf").join(hit, ["image_id", "det_id"], "left").withColumn("tp", F.coalesce("tp", none))


def class_counts(gt: DataFrame) -> DataFrame:
    return gt.groupBy("cls").agg(F.count("*").alias("n_labels"))


def running(flags: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """cls, b, rn, conf, n_labels, points (thr, hit, tps: hits so far) along falling confidence; and totals by cls and cell b.

    Running sums in two levels: confidence cells within a class are windows of their own, and a table of cell totals
    (at most classes x BUCKETS rows) carries the sums over; so a class is not one task. Rows are dealt by
    class and cell once, and both the windows and the totals read them there.
    """
    n = len(THRESHOLDS)
    rows = flags.join(counts, "cls").withColumn("b", cell(F.col("conf"))).repartition("cls", "b")
    inner = Window.partitionBy("cls", "b").orderBy(F.desc("conf"), "image_id", "det_id").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumns({"i": F.count("*").over(inner), **{f"r{k}": F.sum(F.get("tp", F.lit(k))).over(inner) for k in range(n)}})
    totals = rows.groupBy("cls", "b").agg(F.count("*").alias("rows"), *(F.sum(F.get("tp", F.lit(k))).alias(f"t{k}") for k in range(n)))
    before = Window.partitionBy("cls").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("cls", "b", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"c_{c}") for c in ("rows", *(f"t{k}" for k in range(n)))))
    run = run.join(carry, ["cls", "b"])
    points = F.array(*[F.struct(F.lit(k).alias("thr"), F.get("tp", F.lit(k)).alias("hit"), (F.col(f"r{k}") + F.col(f"c_t{k}")).alias("tps")) for k in range(n)])
    return run.select("cls", "b", (F.col("i") + F.col("c_rows")).alias("rn"), "conf", "n_labels", points.alias("points")), totals


def enveloped(long: DataFrame) -> DataFrame:
    """Adds envelope, the greatest precision from here to lower confidence: a reversed prefix maximum in two levels."""
    back = Window.partitionBy("cls", "thr", "b").orderBy(F.desc("rn")).rowsBetween(Window.unboundedPreceding, 0)
    peaks = long.groupBy("cls", "thr", "b").agg(F.max("precision").alias("peak"))
    after = Window.partitionBy("cls", "thr").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    tail = peaks.select("cls", "thr", "b", F.max("peak").over(after).alias("tail"))
    return long.join(tail, ["cls", "thr", "b"]).withColumn("envelope", F.greatest(F.max("precision").over(back), F.coalesce("tail", F.lit(0.0)))).drop("tail")


def curve(flags: DataFrame, counts: DataFrame) -> DataFrame:
    """cls, thr (0..9), rn, conf, recall, precision, envelope along falling confidence."""
    long = running(flags, counts)[0].withColumn("p", F.explode("points")).select("cls", "b", "rn", "conf", "n_labels", "p.*")
    long = long.withColumns({"recall": F.col("tps") / F.col("n_labels"), "precision": F.col("tps") / F.col("rn")})
    return enveloped(long).select("cls", "thr", "rn", "conf", "recall", "precision", "envelope")


def average_precision(gt: DataFrame, det: DataFrame) -> DataFrame:
    """cls, thr, ap of boxes: see precision_of()."""
    return precision_of(flagged(gt, det), class_counts(gt))


def precision_of(flags: DataFrame, counts: DataFrame) -> DataFrame:
    """cls, thr, ap: the envelope between (0, 1) and (1, 0) sampled at 101 recalls, by the trapezoid rule; 0 without detections.

    Recall rises at hits only, and precision falls from one hit to the next. So hits alone make the envelope, and every
    hit ends one segment, whose start follows from its own rank and hits; the last segment leads to (1, 0).
    """
    n = len(THRESHOLDS)
    run, totals = running(flags, counts)
    hits = run.withColumn("p", F.explode(F.filter("points", lambda p: p["hit"] == 1))).select("cls", "b", "rn", "n_labels", "p.thr", "p.tps")
    hits = enveloped(hits.withColumn("precision", F.col("tps") / F.col("rn")))
    start = F.when(F.col("rn") == 1, 1.0).otherwise(F.greatest((F.col("tps") - 1) / F.greatest(F.col("rn") - 1, F.lit(1)), F.col("envelope")))
    rising = hits.select("cls", "thr", ((F.col("tps") - 1) / F.col("n_labels")).alias("recall"), start.alias("envelope"), (F.col("tps") / F.col("n_labels")).alias("r2"), F.col("envelope").alias("e2"))
    whole = totals.groupBy("cls").agg(F.sum("rows").alias("rows"), F.array(*[F.sum(f"t{k}") for k in range(n)]).alias("t")).join(counts, "cls").select("cls", "rows", "n_labels", F.posexplode("t").alias("thr", "t"))
    last = whole.select("cls", "thr", (F.col("t") / F.col("n_labels")).alias("recall"), (F.col("t") / F.col("rows")).alias("envelope"), F.lit(1.0).alias("r2"), F.lit(0.0).alias("e2"))
    seg = rising.unionByName(last).withColumns({"k0": F.ceil(F.col("recall") * 100), "k1": F.ceil(F.col("r2") * 100) - 1}).where("k1 >= k0")
    at = seg.select("*", F.explode(F.sequence("k0", "k1")).alias("k"))
    value = F.col("envelope") + (F.col("e2") - F.col("envelope")) * (F.col("k") / 100 - F.col("recall")) / (F.col("r2") - F.col("recall"))
    ap = at.groupBy("cls", "thr").agg((F.sum(value * F.when(F.col("k") == 0, 0.5).otherwise(1.0)) / 100).alias("ap"))
    grid = counts.select("cls", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("thr"))
    return grid.join(ap, ["cls", "thr"], "left").select("cls", "thr", F.coalesce("ap", F.lit(0.0)).alias("ap"))


def sampled(gt: DataFrame, det: DataFrame, points: int = 1000) -> DataFrame:
    """cls, px (0..points-1), recall, precision at threshold 0.5, at evenly spaced confidences from 0 to 1.

    Linear between detections in confidence order; above the largest confidence recall is 0 and precision 1; where
    several detections share a confidence, interpolation starts at the first of them.
    """
    hits = flagged(gt, det).select("image_id", "det_id", "cls", "conf", F.get("tp", F.lit(0)).alias("hit"))
    level = hits.groupBy("cls", "conf").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"), F.min_by("hit", F.struct("image_id", "det_id")).alias("lead"))
    dealt = level.join(class_counts(gt), "cls").withColumn("b", cell(F.col("conf"))).repartition("cls", "b")
    # two levels, as in running(): a cell's own rows, and what a table of cells carries over
    w = Window.partitionBy("cls", "b").orderBy(F.desc("conf"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = dealt.withColumns({"i": F.sum("n").over(upto), "c": F.sum("hits").over(upto), "up": F.lag(F.struct("conf", "n", "hits")).over(w), "down": F.lead("conf").over(w)})
    cells = dealt.groupBy("cls", "b").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max("conf").alias("high"), F.min("conf").alias("low"))
    by = Window.partitionBy("cls").orderBy("b")
    past = by.rowsBetween(Window.unboundedPreceding, -1)
    carry = cells.select("cls", "b", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("off"), F.coalesce(F.sum("hits").over(past), F.lit(0)).alias("off_hits"), F.lag("low").over(by).alias("above"), F.lead("high").over(by).alias("below"))
    rows = rows.join(carry, ["cls", "b"])

    def at_(seen: Column, found: Column) -> Column:
        return F.struct((found / F.col("n_labels")).alias("recall"), (found / seen).alias("precision"))

    seen, found = F.col("off") + F.col("i") - F.col("n"), F.col("off_hits") + F.col("c") - F.col("hits")  # before this confidence
    seg = rows.select(
        "cls", "conf", at_(seen + 1, found + F.col("lead")).alias("lo"), F.coalesce("up.conf", "above").alias("c2"),
        F.when(seen > 0, at_(seen, found)).alias("n2"), F.coalesce("down", "below").alias("prev"),
    )
    step = F.lit(float(points - 1))
    k0 = F.when(F.col("prev").isNull(), F.lit(0)).otherwise(F.ceil(F.col("conf") * step))
    k1 = F.when(F.col("c2").isNull(), F.lit(points - 1)).otherwise(F.ceil(F.col("c2") * step) - 1)
    at = seg.withColumns({"k0": k0.cast("int"), "k1": k1.cast("int")}).where("k1 >= k0").select("*", F.explode(F.sequence("k0", "k1")).alias("px"))
    x = F.col("px") / step
    share = F.greatest(F.lit(0.0), (x - F.col("conf")) / (F.col("c2") - F.col("conf")))

    def value(name: str, above: float) -> Column:
        here, there = F.col(f"lo.{name}"), F.col(f"n2.{name}")
        return F.when(F.col("c2").isNotNull(), here + (there - here) * share).when(x <= F.col("conf"), here).otherwise(above)

    return at.select("cls", "px", value("recall", 0.0).alias("recall"), value("precision", 1.0).alias("precision"))


def mean_curve(gt: DataFrame, det: DataFrame) -> DataFrame:
    """px, precision, recall, f1: means over the classes that have labels."""
    s = sampled(gt, det).withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-16))
    return s.groupBy("px").agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1")))


def best_f1(gt: DataFrame, det: DataFrame, points: int = 1000, width: int = 101) -> DataFrame:
    """The confidence index of the largest smoothed mean F1 (the ends are padded with the end values), and the means there.

    The means are a row for each of the points: they are gathered into one array, smoothed and searched inside that row.
    """
    half = width // 2
    row = mean_curve(gt, det).agg(F.sort_array(F.collect_list(F.struct("px", "precision", "recall", "f1"))).alias("m")).where(F.size("m") > 0)
    last = F.size("m") - 1

    def smooth(i: Column) -> Column:
        around = F.transform(F.sequence(i - half, i + half), lambda k: F.get(F.col("m"), F.greatest(F.lit(0), F.least(k, last)))["f1"])
        return F.round(F.aggregate(around, F.lit(0.0), lambda s, x: s + x) / width, 12)

    ranked = F.transform("m", lambda x, i: F.struct(smooth(i).alias("s"), (-i).alias("back")))
    return row.select(F.get("m", -F.array_max(ranked)["back"]).alias("b")).select("b.px", "b.precision", "b.recall", "b.f1")


def confusion_pairs(gt: DataFrame, det: DataFrame, conf: float = 0.25, limit: float = 0.45) -> DataFrame:
    """Class-agnostic one-to-one pairs: best label of each detection, then best detection of each label, both by overlap."""
    near = pairs(gt, det.where(F.col("conf") > conf), same_class=False).where(F.col("iou") > limit)
    best = near.withColumn("k", F.row_number().over(Window.partitionBy("image_id", "det_id").orderBy(F.desc("iou"), "gt_id"))).where("k = 1")
    return best.withColumn("k", F.row_number().over(Window.partitionBy("image_id", "gt_id").orderBy(F.desc("iou"), "det_id"))).where("k = 1").select("image_id", "det_id", "gt_id", "cls", "gt_cls", "iou")


def unmatched_labels(gt: DataFrame, matched: DataFrame) -> DataFrame:
    return gt.join(matched, ["image_id", "gt_id"], "left_anti")


def unmatched_detections(det: DataFrame, matched: DataFrame, conf: float = 0.25, only_matched_images: bool = True) -> DataFrame:
    out = det.where(F.col("conf") > conf).join(matched, ["image_id", "det_id"], "left_anti")
    return out.join(matched.select("image_id").distinct(), "image_id", "left_semi") if only_matched_images else out


def confusion(gt: DataFrame, det: DataFrame, classes: int, conf: float = 0.25, limit: float = 0.45) -> DataFrame:
    """pred_cls, true_cls, n; the number of classes stands for the background.

    Labels and confident detections of an image are two arrays of one row. Each detection finds its best label, each
    label the best of the detections that chose it, both inside the row: one grouping by image, then one by cells.
    """
    box = ["cls", "x1", "y1", "x2", "y2"]
    sides = gt.select("image_id", F.struct(F.col("gt_id").cast("long").alias("id"), *box).alias("g"), F.lit(None).alias("d"))
    sides = sides.unionByName(det.where(F.col("conf") > conf).select("image_id", F.lit(None).alias("g"), F.struct(F.col("det_id").cast("long").alias("id"), *box).alias("d")))
    rows = sides.groupBy("image_id").agg(F.collect_list("g").alias("gs"), F.collect_list("d").alias("ds"))
    corners = lambda b: tuple(b[c].cast("double") for c in box[1:])

    def best(d: Column) -> Column:
        near = F.transform("gs", lambda g: F.struct(G.iou(corners(g), corners(d)).alias("iou"), (-g["id"]).alias("neg"), g["cls"].alias("cls")))
        return F.struct(d["id"].alias("id"), d["cls"].alias("cls"), F.array_max(F.filter(near, lambda m: m["iou"] > limit)).alias("m"))

    rows = rows.select("gs", F.transform("ds", best).alias("ds"))
    rivals = lambda g: F.filter("ds", lambda d: -d["m"]["neg"] == g["id"])
    won = F.transform("gs", lambda g: F.struct(g["cls"].alias("cls"), F.array_max(F.transform(rivals(g), lambda d: F.struct(d["m"]["iou"].alias("iou"), (-d["id"]).alias("neg"), d["cls"].alias("cls")))).alias("w")))
    rows = rows.select("ds", won.alias("won"))
    taken, back = F.transform(F.filter("won", lambda x: x["w"].isNotNull()), lambda x: -x["w"]["neg"]), F.lit(classes)
    hits = F.transform("won", lambda x: F.struct(F.coalesce(x["w"]["cls"], back).alias("pred_cls"), x["cls"].alias("true_cls")))
    lost = F.transform(F.filter("ds", lambda d: (F.size(taken) > 0) & ~F.array_contains(taken, d["id"])), lambda d: F.struct(d["cls"].alias("pred_cls"), back.alias("true_cls")))
    return rows.select(F.explode(F.concat(hits, lost)).alias("c")).groupBy("c.pred_cls", "c.true_cls").agg(F.count("*").alias("n"))


def confusion_shares(cells: DataFrame) -> DataFrame:
    """Each cell's share of its true class; null below 0.005."""
    share = F.col("n") / (F.sum("n").over(Window.partitionBy("true_cls")) + 1e-9)
    return cells.select("pred_cls", "true_cls", F.when(share >= 0.005, share).alias("share"))


def tp_fp(cells: DataFrame, classes: int) -> DataFrame:
    """Per class the diagonal, and its row less the diagonal (the background's column counts as false)."""
    hit = F.sum(F.when(F.col("pred_cls") == F.col("true_cls"), F.col("n")).otherwise(0))
    return cells.where(F.col("pred_cls") < classes).groupBy(F.col("pred_cls").alias("cls")).agg(hit.alias("tp"), (F.sum("n") - hit).alias("fp"))


def suppress(det: DataFrame, conf: float, limit: float, agnostic: bool = False, max_candidates: int = 30000, max_kept: int = 300) -> DataFrame:
    """Greedy non-maximum suppression: image_id, det_id, cls, corners, conf of the boxes kept.

    At most ``max_candidates`` boxes of an image are looked at and ``max_kept`` returned, both by confidence. Boxes of a
    group are folded in confidence order inside one row by a higher-order function, with no Python; a candidate that
    overlaps nothing kept is added. Overlap here has no epsilon.
    """
    fields = ["conf", "det_id", "cls", "x1", "y1", "x2", "y2"]
    top = det.where(F.col("conf") > conf).withColumn("k", F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("conf"), "det_id"))).where(F.col("k") <= max_candidates)
    order = F.struct((-F.col("conf")).alias("neg"), *fields[1:], "conf")
    groups = top.groupBy(*(["image_id"] if agnostic else ["image_id", "cls"])).agg(F.sort_array(F.collect_list(order)).alias("boxes"))

    def corners(b: Column):
        return tuple(b[c].cast("double") for c in ("x1", "y1", "x2", "y2"))

    def fold(kept: Column, b: Column) -> Column:
        return F.when(F.exists(kept, lambda k: G.iou(corners(k), corners(b), 0.0) > limit), kept).otherwise(F.concat(kept, F.array(b)))

    kept = F.aggregate(F.slice("boxes", F.lit(2), F.size("boxes")), F.slice("boxes", 1, 1), fold)
    out = groups.select("image_id", F.explode(kept).alias("b")).select("image_id", *(F.col(f"b.{f}").alias(f) for f in fields))
    return out.withColumn("k", F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("conf"), "det_id"))).where(F.col("k") <= max_kept).drop("k")


def expand_classes(raw: DataFrame, conf: float, multi_label: bool = True, classes: list[int] | None = None) -> DataFrame:
    """Rows of (key, obj, scores) to one row a class whose obj * score exceeds conf, or the best class only (the first of ties).

    obj is gated first, and products are made inside the array, before any row is added.
    """
    gated = raw.where(F.col("obj") > conf).withColumn("products", F.transform("scores", lambda s: s * F.col("obj")))
    if multi_label:
        rows = gated.select("*", F.posexplode("products").alias("cls", "conf"))
    else:
        rows = gated.withColumn("conf", F.array_max("products")).withColumn("cls", (F.array_position("products", F.col("conf")) - 1).cast("int"))
    rows = rows.where(F.col("conf") > conf).drop("products", "scores")
    return rows.where(F.col("cls").isin(classes)) if classes is not None else rows


def top_k(scores: DataFrame, k: int = 5) -> DataFrame:
    """Rows of (scores, label) with top1 and topk: whether fewer than 1 (k) classes score above the label."""
    above = F.size(F.filter("scores", lambda s: s > F.get(F.col("scores"), F.col("label"))))
    return scores.withColumns({"top1": (above < 1).cast("int"), "topk": (above < k).cast("int")})
