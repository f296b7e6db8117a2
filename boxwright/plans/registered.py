"""Queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxwright.fixtures import SQL, detections, labels
from boxwright.functions import geometry as G
from boxwright.operators import dataset as D
from boxwright.operators import detection as M
from boxwright.sources import files as S
from boxwright.streaming import frames as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CLASSES = 8
ANCHORS = [(20.0, 30.0), (60.0, 60.0), (110.0, 90.0)]
WITH = f"WITH {SQL}"
IOU = "greatest(least(g.x2, d.x2) - greatest(g.x1, d.x1), 0) * greatest(least(g.y2, d.y2) - greatest(g.y1, d.y1), 0)"
PAIRS = f""", pairs AS (SELECT *, i / (ag + ad - i + 1e-7) AS iou FROM (SELECT d.image_id, d.det_id, d.cls, d.conf, g.gt_id, g.cls AS gt_cls,
  CAST({IOU} AS DOUBLE) AS i, CAST((g.x2 - g.x1) * (g.y2 - g.y1) AS DOUBLE) AS ag, CAST((d.x2 - d.x1) * (d.y2 - d.y1) AS DOUBLE) AS ad
  FROM det d JOIN gt g ON d.image_id = g.image_id))"""
THR = f"(SELECT unnest(range({len(M.THRESHOLDS)})) AS thr, unnest([{', '.join(f'CAST({t} AS DOUBLE)' for t in M.THRESHOLDS)}]) AS t)"
MATCH = f"""{PAIRS}, thr AS {THR},
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, det_id ORDER BY iou DESC, gt_id) AS k FROM pairs WHERE cls = gt_cls AND iou >= 0.5) WHERE k = 1),
tp AS (SELECT * FROM (SELECT o.*, thr.thr, row_number() OVER (PARTITION BY thr.thr, image_id, gt_id ORDER BY conf DESC, det_id) AS j FROM one o JOIN thr ON o.iou >= thr.t) WHERE j = 1)"""
CURVE = f"""{MATCH}, nl AS (SELECT cls, CAST(count(*) AS BIGINT) AS n FROM gt GROUP BY cls),
flag AS (SELECT d.cls, d.conf, d.image_id, d.det_id, thr.thr, CASE WHEN tp.det_id IS NULL THEN 0 ELSE 1 END AS hit FROM det d CROSS JOIN thr
  LEFT JOIN tp ON tp.thr = thr.thr AND tp.image_id = d.image_id AND tp.det_id = d.det_id),
run AS (SELECT f.cls, thr, conf, row_number() OVER w AS rn, CAST(sum(hit) OVER w AS DOUBLE) AS c, n FROM flag f JOIN nl USING (cls)
  WINDOW w AS (PARTITION BY f.cls, thr ORDER BY conf DESC, image_id, det_id ROWS UNBOUNDED PRECEDING)),
pr AS (SELECT cls, thr, conf, rn, c / n AS recall, c / rn AS prec FROM run),
env AS (SELECT *, max(prec) OVER (PARTITION BY cls, thr ORDER BY rn DESC ROWS UNBOUNDED PRECEDING) AS e FROM pr)"""
AP = f"""{CURVE}, pts AS (SELECT cls, thr, rn, recall, e FROM env UNION ALL SELECT cls, thr, 0, 0.0, 1.0 FROM nl CROSS JOIN thr
  UNION ALL SELECT cls, thr, 4611686018427387904, 1.0, 0.0 FROM nl CROSS JOIN thr),
seg AS (SELECT *, lead(recall) OVER w AS r2, lead(e) OVER w AS e2 FROM pts WINDOW w AS (PARTITION BY cls, thr ORDER BY rn)),
gp AS (SELECT s.*, k FROM seg s JOIN (SELECT unnest(range(101)) AS k) ON k >= ceil(recall * 100) AND k < ceil(r2 * 100)),
ap AS (SELECT cls, thr, sum((e + (e2 - e) * (k / 100.0::DOUBLE - recall) / (r2 - recall)) * CASE WHEN k = 0 THEN 0.5 ELSE 1 END) / 100 AS ap FROM gp GROUP BY cls, thr)"""
CONF = f"""{PAIRS}, a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, det_id ORDER BY iou DESC, gt_id) AS k FROM pairs WHERE conf > 0.25 AND iou > 0.45) WHERE k = 1),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, gt_id ORDER BY iou DESC, det_id) AS j FROM a) WHERE j = 1),
ul AS (SELECT g.* FROM gt g LEFT JOIN (SELECT image_id, gt_id, 1 AS hit FROM m) x USING (image_id, gt_id) WHERE hit IS NULL),
ud AS (SELECT d.* FROM det d JOIN (SELECT DISTINCT image_id FROM m) i USING (image_id) LEFT JOIN (SELECT image_id, det_id, 1 AS hit FROM m) x USING (image_id, det_id) WHERE conf > 0.25 AND hit IS NULL),
cells AS (SELECT pred_cls, true_cls, count(*) AS n FROM (SELECT cls AS pred_cls, gt_cls AS true_cls FROM m UNION ALL SELECT 8, cls FROM ul UNION ALL SELECT cls, 8 FROM ud) GROUP BY ALL)"""


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(names: list[str], columns, digits: int = 6):
    """Rounded columns; a shift far below the last place keeps exact halves from falling either way by engine."""
    return [F.round(c + 1e-9, digits).alias(n) for n, c in zip(names, columns, strict=True)]


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return labels(spark, sf_dir), detections(spark, sf_dir)


@register(f"{WITH} SELECT image_id, gt_id, (x1 + x2) / 2.0::DOUBLE AS x, (y1 + y2) / 2.0::DOUBLE AS y, CAST(x2 - x1 AS DOUBLE) AS w, CAST(y2 - y1 AS DOUBLE) AS h FROM gt")
def box_convert(spark, sf_dir):
    return labels(spark, sf_dir).select("image_id", "gt_id", *(c.alias(n) for n, c in zip("xywh", G.to_center(G.columns()), strict=True)))


@register(f"""{WITH}, c AS (SELECT image_id, gt_id, least(x1, 640) AS a, least(y1, 480) AS b, least(x2, 640) AS c, least(y2, 480) AS d FROM gt)
SELECT image_id, gt_id, round((a + c) / 2.0::DOUBLE / 640 + 1e-9, 6) AS x, round((b + d) / 2.0::DOUBLE / 480 + 1e-9, 6) AS y, round((c - a) / 640.0::DOUBLE + 1e-9, 6) AS w, round((d - b) / 480.0::DOUBLE + 1e-9, 6) AS h FROM c""")
def box_normalize(spark, sf_dir):
    return labels(spark, sf_dir).select("image_id", "gt_id", *rounded(list("xywh"), G.normalised(G.columns(), 640.0, 480.0, clip=True)))


@register(f"""{WITH} SELECT image_id, det_id, round(greatest(0, least(x1 / 0.5::DOUBLE, 1280)) + 1e-9, 6) AS x1, round(greatest(0, least((y1 - 140) / 0.5::DOUBLE, 720)) + 1e-9, 6) AS y1,
round(greatest(0, least(x2 / 0.5::DOUBLE, 1280)) + 1e-9, 6) AS x2, round(greatest(0, least((y2 - 140) / 0.5::DOUBLE, 720)) + 1e-9, 6) AS y2 FROM det""")
def scale_clip(spark, sf_dir):
    return detections(spark, sf_dir).select("image_id", "det_id", *rounded(["x1", "y1", "x2", "y2"], G.rescaled(G.columns(), (640, 640), (1280, 720))))


@register("""WITH s AS (SELECT p_partkey, CAST(100 + p_size * 37 AS DOUBLE) AS w, CAST(80 + (p_partkey * 13) % 900 AS DOUBLE) AS h FROM part),
g AS (SELECT *, least(640 / h, 640 / w) AS gain FROM s), n AS (SELECT *, round_even(w * gain, 0) AS nw, round_even(h * gain, 0) AS nh FROM g),
p AS (SELECT *, ((640 - nw) % 32) / 2 AS dw, ((640 - nh) % 32) / 2 AS dh FROM n)
SELECT p_partkey, round(gain + 1e-9, 6) AS gain, CAST(nw AS BIGINT) AS new_w, CAST(nh AS BIGINT) AS new_h, CAST(round_even(dw - 0.1, 0) AS BIGINT) AS "left", CAST(round_even(dw + 0.1, 0) AS BIGINT) AS "right",
CAST(round_even(dh - 0.1, 0) AS BIGINT) AS top, CAST(round_even(dh + 0.1, 0) AS BIGINT) AS bottom FROM p""")
def letterbox_geom(spark, sf_dir):
    s = table(spark, sf_dir, "part").select("p_partkey", (100 + F.col("p_size") * 37).cast("double").alias("w"), (80 + F.col("p_partkey") * 13 % 900).cast("double").alias("h"))
    out = G.letterbox(F.col("w"), F.col("h"), 640)
    return s.select("p_partkey", F.round(out.pop("gain"), 6).alias("gain"), *(c.cast("long").alias(n) for n, c in out.items()))


@register(f"{WITH}{PAIRS} SELECT image_id, det_id, gt_id, round(iou + 1e-9, 6) AS iou FROM pairs WHERE iou > 0 AND cls = gt_cls")
def iou_pairs(spark, sf_dir):
    return M.pairs(*both(spark, sf_dir)).where("iou > 0").select("image_id", "det_id", "gt_id", F.round(F.col("iou") + 1e-9, 6).alias("iou"))


@register(f"""{WITH}, p AS (SELECT d.image_id, d.det_id, g.gt_id, CAST(g.x1 AS DOUBLE) a1, CAST(g.y1 AS DOUBLE) a2, CAST(g.x2 AS DOUBLE) a3, CAST(g.y2 AS DOUBLE) a4, CAST(d.x1 AS DOUBLE) b1, CAST(d.y1 AS DOUBLE) b2, CAST(d.x2 AS DOUBLE) b3, CAST(d.y2 AS DOUBLE) b4
  FROM det d JOIN gt g ON d.image_id = g.image_id AND d.cls = g.cls),
q AS (SELECT *, greatest(least(a3, b3) - greatest(a1, b1), 0) * greatest(least(a4, b4) - greatest(a2, b2), 0) AS i, a3 - a1 AS w1, greatest(a4 - a2, 1e-7) AS h1, b3 - b1 AS w2, greatest(b4 - b2, 1e-7) AS h2,
  greatest(a3, b3) - least(a1, b1) AS cw, greatest(a4, b4) - least(a2, b2) AS ch FROM p),
r AS (SELECT *, w1 * h1 + w2 * h2 - i + 1e-7 AS u, cw * ch + 1e-7 AS hull, cw * cw + ch * ch + 1e-7 AS dg, (pow(b1 + b3 - a1 - a3, 2) + pow(b2 + b4 - a2 - a4, 2)) / 4 AS gap, pow(atan(w2 / h2) - atan(w1 / h1), 2) * 4 / pow(pi(), 2) AS v FROM q),
s AS (SELECT *, i / u AS iou FROM r)
SELECT image_id, det_id, gt_id, round(iou - (hull - u) / hull + 1e-9, 6) AS giou, round(iou - gap / dg + 1e-9, 6) AS diou, round(iou - (gap / dg + v * v / (v - iou + 1 + 1e-7)) + 1e-9, 6) AS ciou FROM s""")
def giou_diou_ciou(spark, sf_dir):
    out = G.generalised_iou(G.columns("g_"), G.columns())
    return M.pairs(*both(spark, sf_dir)).select("image_id", "det_id", "gt_id", *rounded(["giou", "diou", "ciou"], [out[k] for k in ("giou", "diou", "ciou")]))


@register(f"""{WITH}{PAIRS} SELECT image_id, det_id FROM det LEFT JOIN (SELECT DISTINCT image_id, det_id, 1 AS hidden FROM pairs WHERE i / (ad + 1e-7) >= 0.6) USING (image_id, det_id) WHERE hidden IS NULL""")
def ioa_filter(spark, sf_dir):
    gt, det = both(spark, sf_dir)
    hidden = M.pairs(gt, det, same_class=False).where(G.ioa(G.columns("g_"), G.columns()) >= 0.6)
    return det.join(hidden.select("image_id", "det_id"), ["image_id", "det_id"], "left_anti").select("image_id", "det_id")


@register(f"{WITH}{MATCH} SELECT CAST(thr AS INT) AS thr, count(*) AS tp FROM tp GROUP BY thr")
def match_tp_counts(spark, sf_dir):
    return M.match(*both(spark, sf_dir)).select(F.posexplode("tp").alias("thr", "hit")).groupBy("thr").agg(F.sum("hit").alias("tp"))


@register(f"{WITH}{CURVE} SELECT cls, CAST(thr AS INT) AS thr, CAST(rn AS BIGINT) AS rn, round(recall + 1e-9, 6) AS recall, round(prec + 1e-9, 6) AS prec, round(e + 1e-9, 6) AS envelope FROM env")
def pr_curve(spark, sf_dir):
    """The curves of all thresholds."""
    gt, det = both(spark, sf_dir)
    return M.curve(M.flagged(gt, det), M.class_counts(gt)).select("cls", "thr", "rn", *rounded(["recall", "prec", "envelope"], map(F.col, ("recall", "precision", "envelope"))))


@register(f"{WITH}{AP} SELECT cls, CAST(thr AS INT) AS thr, round(ap + 1e-9, 6) AS ap FROM ap")
def ap_per_class(spark, sf_dir):
    return M.average_precision(*both(spark, sf_dir)).select("cls", "thr", F.round(F.col("ap") + 1e-9, 6).alias("ap"))


@register(f"{WITH}{AP} SELECT round(avg(ap) FILTER (thr = 0) + 1e-9, 6) AS map50, round(avg(ap) + 1e-9, 6) AS map FROM ap")
def map_summary(spark, sf_dir):
    return M.average_precision(*both(spark, sf_dir)).agg(F.round(F.avg(F.when(F.col("thr") == 0, F.col("ap"))), 6).alias("map50"), F.round(F.avg("ap") + 1e-9, 6).alias("map"))


F1 = f"""{CURVE}, d0 AS (SELECT cls, conf, min_by(recall, rn) AS r, min_by(prec, rn) AS p, max_by(recall, rn) AS rl, max_by(prec, rn) AS pl FROM pr WHERE thr = 0 GROUP BY cls, conf),
s0 AS (SELECT *, lead(conf) OVER w AS c2, lead(rl) OVER w AS r2, lead(pl) OVER w AS p2, lag(conf) OVER w AS c0 FROM d0 WINDOW w AS (PARTITION BY cls ORDER BY conf)),
g AS (SELECT unnest(range(1000)) AS px),
x AS (SELECT s.*, g.px, px / 999.0::DOUBLE AS v FROM s0 s JOIN g ON px >= CASE WHEN c0 IS NULL THEN 0 ELSE ceil(conf * 999) END AND px < CASE WHEN c2 IS NULL THEN 1000 ELSE ceil(c2 * 999) END),
y AS (SELECT cls, px, CASE WHEN c2 IS NOT NULL THEN r + (r2 - r) * greatest(0, (v - conf) / (c2 - conf)) WHEN v <= conf THEN r ELSE 0 END AS r, CASE WHEN c2 IS NOT NULL THEN p + (p2 - p) * greatest(0, (v - conf) / (c2 - conf)) WHEN v <= conf THEN p ELSE 1 END AS p FROM x),
mc AS (SELECT px, avg(p) AS precision, avg(r) AS recall, avg(2 * p * r / (p + r + 1e-16)) AS f1 FROM y GROUP BY px)"""


@register(f"{WITH}{F1} SELECT CAST(px AS INT) AS px, round(precision + 1e-9, 6) AS precision, round(recall + 1e-9, 6) AS recall, round(f1 + 1e-9, 6) AS f1 FROM mc")
def f1_curve(spark, sf_dir):
    return M.mean_curve(*both(spark, sf_dir)).select("px", *rounded(["precision", "recall", "f1"], map(F.col, ("precision", "recall", "f1"))))


@register(f"""{WITH}{F1}, pad AS (SELECT px AS pos, f1 FROM mc UNION ALL SELECT -k, f1 FROM mc, (SELECT unnest(range(1, 51)) AS k) WHERE px = 0 UNION ALL SELECT 999 + k, f1 FROM mc, (SELECT unnest(range(1, 51)) AS k) WHERE px = 999),
sm AS (SELECT pos, avg(f1) OVER (ORDER BY pos ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING) AS s FROM pad),
b AS (SELECT pos FROM sm WHERE pos BETWEEN 0 AND 999 ORDER BY round(s, 12) DESC, pos LIMIT 1)
SELECT CAST(px AS INT) AS px, round(precision + 1e-9, 6) AS precision, round(recall + 1e-9, 6) AS recall, round(f1 + 1e-9, 6) AS f1 FROM mc JOIN b ON px = pos""")
def best_f1(spark, sf_dir):
    return M.best_f1(*both(spark, sf_dir)).select("px", *rounded(["precision", "recall", "f1"], map(F.col, ("precision", "recall", "f1"))))


@register(f"{WITH}{CONF} SELECT CAST(pred_cls AS INT) AS pred_cls, CAST(true_cls AS INT) AS true_cls, n FROM cells")
def confusion_matrix(spark, sf_dir):
    return M.confusion(*both(spark, sf_dir), CLASSES)


@register(f"{WITH}{CONF}, sh AS (SELECT *, n / (sum(n) OVER (PARTITION BY true_cls) + 1e-9) AS s FROM cells) SELECT CAST(pred_cls AS INT) AS pred_cls, CAST(true_cls AS INT) AS true_cls, CASE WHEN s >= 0.005 THEN round(s + 1e-9, 6) END AS share FROM sh")
def confusion_normalized(spark, sf_dir):
    return M.confusion_shares(M.confusion(*both(spark, sf_dir), CLASSES)).withColumn("share", F.round(F.col("share") + 1e-9, 6))


@register(f"{WITH}{CONF} SELECT CAST(pred_cls AS INT) AS cls, CAST(coalesce(sum(n) FILTER (pred_cls = true_cls), 0) AS BIGINT) AS tp, CAST(coalesce(sum(n) FILTER (pred_cls <> true_cls), 0) AS BIGINT) AS fp FROM cells WHERE pred_cls < 8 GROUP BY 1")
def tp_fp(spark, sf_dir):
    return M.tp_fp(M.confusion(*both(spark, sf_dir), CLASSES), CLASSES)


@register(f"{WITH}{CONF} SELECT image_id, gt_id, cls FROM ul")
def unmatched_labels(spark, sf_dir):
    gt, det = both(spark, sf_dir)
    return M.unmatched_labels(gt, M.confusion_pairs(gt, det)).select("image_id", "gt_id", "cls")


@register(f"{WITH}{CONF} SELECT image_id, det_id, cls FROM ud")
def unmatched_dets(spark, sf_dir):
    gt, det = both(spark, sf_dir)
    return M.unmatched_detections(det, M.confusion_pairs(gt, det)).select("image_id", "det_id", "cls")


def nms_sql(agnostic: bool, source: str = "SELECT * FROM det WHERE conf > 0.05") -> str:
    key, same = ("image_id", "") if agnostic else ("image_id, cls", " AND n.cls = k.cls")
    return f"""WITH RECURSIVE {SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY conf DESC, det_id) AS k FROM ({source})),
st AS (SELECT image_id, cls, k, [{{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'det_id': det_id}}] AS kept FROM c WHERE k = 1
UNION ALL SELECT n.image_id, k.cls, n.k, CASE WHEN len(list_filter(k.kept, lambda b: greatest(least(b.x2, n.x2) - greatest(b.x1, n.x1), 0) * greatest(least(b.y2, n.y2) - greatest(b.y1, n.y1), 0)
  / CAST((b.x2 - b.x1) * (b.y2 - b.y1) + (n.x2 - n.x1) * (n.y2 - n.y1) - greatest(least(b.x2, n.x2) - greatest(b.x1, n.x1), 0) * greatest(least(b.y2, n.y2) - greatest(b.y1, n.y1), 0) AS DOUBLE) > 0.45)) > 0
  THEN k.kept ELSE list_append(k.kept, {{'x1': n.x1, 'y1': n.y1, 'x2': n.x2, 'y2': n.y2, 'det_id': n.det_id}}) END
  FROM st k JOIN c n ON n.image_id = k.image_id{same} AND n.k = k.k + 1),
f AS (SELECT image_id, max_by(kept, k) AS kept FROM st GROUP BY {key})
SELECT image_id, u.det_id AS det_id FROM (SELECT image_id, unnest(kept) AS u FROM f)"""


@register(nms_sql(False))
def nms_keep(spark, sf_dir):
    return M.suppress(detections(spark, sf_dir), 0.05, 0.45).select("image_id", "det_id")


@register(nms_sql(True))
def nms_agnostic(spark, sf_dir):
    return M.suppress(detections(spark, sf_dir), 0.05, 0.45, agnostic=True).select("image_id", "det_id")


_TOP3 = "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_id) AS r FROM det WHERE conf > 0.05) WHERE r <= 3"


@register(f"WITH n AS ({nms_sql(False, _TOP3)}), {SQL} SELECT image_id, det_id FROM (SELECT n.*, row_number() OVER (PARTITION BY n.image_id ORDER BY conf DESC, det_id) AS r FROM n JOIN det USING (image_id, det_id)) WHERE r <= 2")
def nms_limited(spark, sf_dir):
    """Suppression among the three best boxes of an image, of which two are given."""
    return M.suppress(detections(spark, sf_dir), 0.05, 0.45, max_candidates=3, max_kept=2).select("image_id", "det_id")


@register(f"{WITH} SELECT image_id, det_id, CAST(k AS INT) AS k FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_id) AS k FROM det) WHERE k <= 5")
def topk_per_image(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("conf"), "det_id"))
    return detections(spark, sf_dir).withColumn("k", k).where("k <= 5").select("image_id", "det_id", "k")


def raw(spark, sf_dir):
    s = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label"), s.alias("scores"), (F.col("vec_id") % 10 / 10).alias("obj"))


RAW = "WITH r AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS s, (vec_id % 10) / 10.0::DOUBLE AS obj FROM embeddings)"


@register(f"{RAW}, u AS (SELECT vec_id, obj, unnest(s) AS v, unnest(range(len(s))) AS cls FROM r WHERE obj > 0.25) SELECT vec_id, CAST(cls AS INT) AS cls, round(v * obj + 1e-9, 6) AS conf FROM u WHERE v * obj > 0.05")
def multi_label_expand(spark, sf_dir):
    return M.expand_classes(raw(spark, sf_dir).withColumn("obj", F.col("obj")), 0.05).where("obj > 0.25").select("vec_id", "cls", F.round(F.col("conf") + 1e-9, 6).alias("conf"))


@register(f"{RAW} SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS INT) AS cls, round(list_max(s) * obj + 1e-9, 6) AS conf FROM r WHERE obj > 0.05 AND list_max(s) * obj > 0.05")
def best_class(spark, sf_dir):
    return M.expand_classes(raw(spark, sf_dir), 0.05, multi_label=False).select("vec_id", "cls", F.round(F.col("conf") + 1e-9, 6).alias("conf"))


TOP = f"{RAW}, t AS (SELECT label, CAST(len(list_filter(s, lambda v: v > s[label + 1])) < 1 AS INT) AS a, CAST(len(list_filter(s, lambda v: v > s[label + 1])) < 5 AS INT) AS b FROM r)"


@register(f"{TOP} SELECT round(avg(a) + 1e-9, 6) AS top1, round(avg(b) + 1e-9, 6) AS top5 FROM t")
def top1_top5(spark, sf_dir):
    return M.top_k(raw(spark, sf_dir)).agg(F.round(F.avg("top1") + 1e-9, 6).alias("top1"), F.round(F.avg("topk") + 1e-9, 6).alias("top5"))


@register(f"{TOP} SELECT CAST(coalesce(label, -1) AS INT) AS label, round(avg(a) + 1e-9, 6) AS top1, round(avg(b) + 1e-9, 6) AS top5 FROM t GROUP BY ROLLUP (label)")
def top1_by_class_rollup(spark, sf_dir):
    return M.top_k(raw(spark, sf_dir)).rollup("label").agg(F.round(F.avg("top1") + 1e-9, 6).alias("top1"), F.round(F.avg("topk") + 1e-9, 6).alias("top5")).withColumn("label", F.coalesce("label", F.lit(-1)))


def images(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), D.hash_split(F.col("o_orderkey")).alias("split"), F.round(F.col("o_totalprice") / 1000, 3).alias("aspect"))


SPLIT = "CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 6) AS BIGINT) % 1000 < 900 THEN 'train' ELSE 'val' END"


@register(f"SELECT o_orderkey AS image_id, {SPLIT} AS split FROM orders")
def hash_split(spark, sf_dir):
    return images(spark, sf_dir).select("image_id", "split")


@register(f"""{WITH}, im AS (SELECT o_orderkey AS image_id, {SPLIT} AS split FROM orders), j AS (SELECT im.*, gt.gt_id, gt.cls FROM im LEFT JOIN gt USING (image_id))
SELECT split, CAST(coalesce(cls, -1) AS INT) AS cls, CAST(grouping(cls) AS INT) AS total, count(gt_id) AS instances, count(DISTINCT CASE WHEN gt_id IS NOT NULL THEN image_id END) AS labelled, count(DISTINCT CASE WHEN gt_id IS NULL THEN image_id END) AS unlabelled
FROM j GROUP BY GROUPING SETS ((split), (split, cls)) HAVING grouping(cls) = 1 OR cls IS NOT NULL""")
def dataset_stats(spark, sf_dir):
    return D.statistics(labels(spark, sf_dir), images(spark, sf_dir)).withColumns({"cls": F.coalesce("cls", F.lit(-1)), "total": F.col("total").cast("int")})


def class_table(spark):
    return spark.range(10).select(F.col("id").cast("int").alias("cls"))


HIST = f"{WITH}, d AS (SELECT CAST(unnest(range(10)) AS INT) AS cls), h AS (SELECT d.cls, count(gt.gt_id) AS n FROM d LEFT JOIN gt USING (cls) GROUP BY d.cls), w AS (SELECT cls, 1.0::DOUBLE / greatest(n, 1) / sum(1.0::DOUBLE / greatest(n, 1)) OVER () AS weight FROM h)"


@register(f"{HIST} SELECT cls, n FROM h")
def class_hist_zero_filled(spark, sf_dir):
    return D.class_histogram(labels(spark, sf_dir), class_table(spark))


@register(f"{HIST} SELECT cls, round(weight, 9) AS weight FROM w")
def class_weights(spark, sf_dir):
    return D.class_weights(labels(spark, sf_dir), class_table(spark)).withColumn("weight", F.round("weight", 9))


@register(f"{HIST} SELECT image_id, round(sum(weight), 9) AS weight FROM gt JOIN w USING (cls) GROUP BY image_id")
def image_weights(spark, sf_dir):
    gt = labels(spark, sf_dir)
    return D.image_weights(gt, D.class_weights(gt, class_table(spark))).withColumn("weight", F.round("weight", 9))


@register("SELECT DISTINCT CAST(l_orderkey AS BIGINT) AS image_id, CAST(l_linenumber % 3 AS INT) AS cls, CAST(l_partkey % 5 AS INT) AS x1, CAST(l_suppkey % 5 AS INT) AS y1, 9 AS x2, 9 AS y2 FROM lineitem")
def label_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image_id"), (F.col("l_linenumber") % 3).alias("cls"), (F.col("l_partkey") % 5).cast("int").alias("x1"), (F.col("l_suppkey") % 5).cast("int").alias("y1"), F.lit(9).alias("x2"), F.lit(9).alias("y2"))
    return D.distinct_labels(rows)


@register("""WITH r AS (SELECT l_orderkey AS image_id, CAST(l_partkey % 12 AS INT) AS cls, CASE WHEN l_quantity = 7 THEN NULL ELSE l_discount * 11 - 0.02 END AS x, l_tax * 10 AS y, l_quantity / 45 AS w, 0.5::DOUBLE AS h FROM lineitem),
s AS (SELECT CASE WHEN x IS NULL THEN 'missing' WHEN least(cls, x, y, w, h) < 0 THEN 'negative' WHEN greatest(x, y, w, h) > 1 THEN 'outside' WHEN cls >= 10 THEN 'class' ELSE 'ok' END AS status FROM r) SELECT status, count(*) AS n FROM s GROUP BY status""")
def label_status(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 12).cast("int").alias("cls"), F.when(F.col("l_quantity") != 7, F.col("l_discount") * 11 - 0.02).alias("x"), (F.col("l_tax") * 10).alias("y"), (F.col("l_quantity") / 45).alias("w"), F.lit(0.5).alias("h"))
    return D.label_status(li, 10).groupBy("status").agg(F.count("*").alias("n"))


@register(f"{WITH} SELECT image_id, count(*) AS n FROM gt GROUP BY image_id HAVING count(*) >= 6")
def min_items_images(spark, sf_dir):
    return D.images_with(labels(spark, sf_dir), 6)


@register("""WITH a AS (SELECT round(o_totalprice / 1000, 3) AS aspect, row_number() OVER (ORDER BY round(o_totalprice / 1000, 3), o_orderkey) - 1 AS i FROM orders)
SELECT CAST(floor(i / 16) AS BIGINT) AS batch, count(*) AS n, min(aspect) AS least, max(aspect) AS most FROM a GROUP BY 1""")
def rect_batches(spark, sf_dir):
    return D.rect_batches(images(spark, sf_dir), 16)


RATIO = ", ".join(f"least(w / {a}, {a} / w, h / {b}, {b} / h)" for a, b in ANCHORS)
SIZES = f"{WITH}, z AS (SELECT image_id, gt_id, x1 / 16.0::DOUBLE AS x, y1 / 16.0::DOUBLE AS y, CAST(x2 - x1 AS DOUBLE) AS w, CAST(y2 - y1 AS DOUBLE) AS h FROM gt)"


def sizes(spark, sf_dir):
    return labels(spark, sf_dir).select("image_id", "gt_id", (F.col("x1") / 16).alias("x"), (F.col("y1") / 16).alias("y"), (F.col("x2") - F.col("x1")).cast("double").alias("w"), (F.col("y2") - F.col("y1")).cast("double").alias("h"))


@register(f"""{SIZES}, r AS (SELECT [{RATIO}] AS r FROM z) SELECT round(avg(CAST(list_max(r) > 0.5 AS DOUBLE)) + 1e-9, 6) AS bpr, round(avg(CAST(len(list_filter(r, lambda v: v > 0.5)) AS DOUBLE)), 6) AS aat,
round(avg(list_max(r) * CAST(list_max(r) > 0.5 AS DOUBLE)) + 1e-9, 6) AS fitness FROM r""")
def anchor_bpr_aat(spark, sf_dir):
    return D.anchor_fit(sizes(spark, sf_dir), ANCHORS, 2.0).select(*rounded(["bpr", "aat", "fitness"], map(F.col, ("bpr", "aat", "fitness"))))


@register(f"""{SIZES}, f AS (SELECT z.*, unnest([{RATIO}]) AS r, unnest(range(3)) AS anchor FROM z), o AS (SELECT * FROM f WHERE 1 / r < 2),
c AS (SELECT *, 0.0 AS dx, 0.0 AS dy FROM o UNION ALL SELECT *, -0.5, 0 FROM o WHERE x - floor(x) < 0.5 AND x > 1 UNION ALL SELECT *, 0, -0.5 FROM o WHERE y - floor(y) < 0.5 AND y > 1
  UNION ALL SELECT *, 0.5, 0 FROM o WHERE (40 - x) - floor(40 - x) < 0.5 AND 40 - x > 1 UNION ALL SELECT *, 0, 0.5 FROM o WHERE (40 - y) - floor(40 - y) < 0.5 AND 40 - y > 1)
SELECT image_id, gt_id, CAST(anchor AS INT) AS anchor, CAST(greatest(0, least(floor(x + dx), 39)) AS INT) AS gx, CAST(greatest(0, least(floor(y + dy), 39)) AS INT) AS gy FROM c""")
def target_assign(spark, sf_dir):
    return D.assign(sizes(spark, sf_dir), ANCHORS, 40, 2.0).select("image_id", "gt_id", "anchor", "gx", "gy")


@register(f"{SIZES} SELECT round(avg(w) + 1e-9, 6) AS w_mean, round(stddev_pop(w) + 1e-9, 6) AS w_std, round(avg(h) + 1e-9, 6) AS h_mean, round(stddev_pop(h) + 1e-9, 6) AS h_std, count(*) FILTER (w < 30 OR h < 30) AS small FROM z")
def wh_stats(spark, sf_dir):
    z = sizes(spark, sf_dir)
    return z.agg(*rounded(["w_mean", "w_std", "h_mean", "h_std"], [F.avg("w"), F.stddev_pop("w"), F.avg("h"), F.stddev_pop("h")]), F.count_if((F.col("w") < 30) | (F.col("h") < 30)).alias("small"))


@register(f"{SIZES} SELECT CAST(floor(w / 10) AS BIGINT) AS bx, CAST(floor(h / 10) AS BIGINT) AS \"by\", count(*) AS n, round(ln(count(*)) + 1e-9, 6) AS log_n FROM z GROUP BY 1, 2")
def hist2d_density(spark, sf_dir):
    return D.density(sizes(spark, sf_dir), "w", "h", 10, 10).withColumn("log_n", F.round(F.col("log_n") + 1e-9, 6))


@register("SELECT round(regr_slope(l_extendedprice, l_quantity) + 1e-9, 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity) + 1e-9, 4) AS intercept FROM lineitem")
def batch_fit(spark, sf_dir):
    return D.line_fit(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice").select(*rounded(["slope", "intercept"], map(F.col, ("slope", "intercept")), 4))


def runs(spark, sf_dir):
    epoch = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), epoch.alias("epoch"), F.col("value").alias("fit"), "event_id", "ts", "event_type")


RUNS = "WITH r AS (SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS epoch, value AS fit, event_id, ts, event_type FROM events)"
STOP = f"{RUNS}, b AS (SELECT *, max(fit) OVER (PARTITION BY run_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS best FROM r)"


@register(f"{STOP}, e AS (SELECT *, max(CASE WHEN fit >= best THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS best_epoch FROM b) SELECT run_id, epoch, best, best_epoch, epoch - best_epoch >= 10 AS stop FROM e")
def early_stop(spark, sf_dir):
    return D.early_stop(runs(spark, sf_dir), 10).select("run_id", "epoch", "best", "best_epoch", "stop")


@register(f"{RUNS} SELECT run_id, epoch, max(fit) OVER (PARTITION BY run_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS best FROM r")
def running_best(spark, sf_dir):
    return D.running_best(runs(spark, sf_dir), "fit").select("run_id", "epoch", "best")


@register(f"{RUNS} SELECT run_id, epoch, round(avg(fit) OVER (PARTITION BY run_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) + 1e-9, 6) AS mean FROM r")
def running_mean(spark, sf_dir):
    return D.running_mean(runs(spark, sf_dir), "fit").select("run_id", "epoch", F.round(F.col("mean") + 1e-9, 6).alias("mean"))


@register(f"""WITH RECURSIVE {RUNS.removeprefix("WITH ")}, m AS (SELECT run_id, epoch, fit * (1 - 0.99 * (1 - exp(-1 / 20.0::DOUBLE))) AS ema FROM r WHERE epoch = 1
UNION ALL SELECT r.run_id, r.epoch, m.ema * 0.99 * (1 - exp(-r.epoch / 20.0::DOUBLE)) + r.fit * (1 - 0.99 * (1 - exp(-r.epoch / 20.0::DOUBLE))) FROM m JOIN r ON r.run_id = m.run_id AND r.epoch = m.epoch + 1)
SELECT run_id, round(max_by(ema, epoch) + 1e-9, 6) AS ema FROM m GROUP BY run_id""")
def ema(spark, sf_dir):
    return D.ramped_average(runs(spark, sf_dir), "fit", 0.99, 20).withColumn("ema", F.round(F.col("ema") + 1e-9, 6))


@register(f"{RUNS} SELECT run_id, epoch, round(0.1 * fit + 0.9 * epoch + 1e-9, 6) AS fitness FROM r ORDER BY 0.1 * fit + 0.9 * epoch DESC, run_id LIMIT 5")
def fitness_topn(spark, sf_dir):
    return runs(spark, sf_dir).withColumn("f", D.fitness({"fit": 0.1, "epoch": 0.9})).orderBy(F.desc("f"), "run_id").limit(5).select("run_id", "epoch", F.round(F.col("f") + 1e-9, 6).alias("fitness"))


def frames(spark, sf_dir):
    return runs(spark, sf_dir).select(F.col("run_id").alias("source_id"), "ts", F.col("epoch").alias("frame_no"), F.col("event_type").alias("label"))


@register(f"{RUNS} SELECT run_id AS source_id, max(epoch) AS frame_no, max_by(event_type, epoch) AS label FROM r GROUP BY run_id")
def latest_per_source(spark, sf_dir):
    return R.latest(frames(spark, sf_dir))


@register(f"{RUNS} SELECT run_id AS source_id, epoch AS frame_no FROM r WHERE epoch % 4 = 0")
def frame_stride(spark, sf_dir):
    return R.every(frames(spark, sf_dir), 4).select("source_id", "frame_no")


@register("SELECT user_id AS source_id, event_type AS label, count(*) AS n FROM events GROUP BY ALL")
def source_class_counts(spark, sf_dir):
    return R.counts(frames(spark, sf_dir))


@register("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type AS label, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark, sf_dir):
    return R.tumbling(frames(spark, sf_dir), "1 hour")


@register("""WITH a AS (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events),
b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM a) SELECT user_id AS source_id, min(ts) AS start, count(*) AS n FROM b GROUP BY user_id, s""")
def session_counts(spark, sf_dir):
    return R.sessions(frames(spark, sf_dir), "30 minutes")


@register(f"{WITH} SELECT image_id, det_id, cls AS category_id, CAST(x1 AS DOUBLE) AS x, CAST(y1 AS DOUBLE) AS y, CAST(x2 - x1 AS DOUBLE) AS w, CAST(y2 - y1 AS DOUBLE) AS h, round_even(conf, 5) AS score FROM det")
def coco_json_rows(spark, sf_dir):
    det = detections(spark, sf_dir)
    rows = S.coco_results(det.withColumn("image_id", F.struct("image_id", "det_id")))
    return rows.select("image_id.image_id", "image_id.det_id", "category_id", *(F.col("bbox")[k].alias(c) for k, c in enumerate("xywh")), "score")


@register(f"""{WITH} SELECT image_id, cls || ' ' || printf('%g', (x1 + x2) / 2000.0::DOUBLE) || ' ' || printf('%g', (y1 + y2) / 2000.0::DOUBLE) || ' ' || printf('%g', (x2 - x1) / 1000.0::DOUBLE) || ' ' || printf('%g', (y2 - y1) / 1000.0::DOUBLE) || ' ' || printf('%g', conf) AS value FROM det""")
def label_txt_rows(spark, sf_dir):
    rows = detections(spark, sf_dir).select("image_id", "cls", *(c.alias(n) for n, c in zip("xywh", G.normalised(G.columns(), 1000.0, 1000.0), strict=True)), "conf")
    return S.label_text(rows)


@register("SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def class_name_join(spark, sf_dir):
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("n"))


@register("SELECT p_partkey, CAST([11, 22, 33, 44, 55, 66, 77, 88][CAST(p_size % 8 AS INT) + 1] AS INT) AS category FROM part")
def category_map(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.get(F.array(*map(F.lit, range(11, 99, 11))), F.col("p_size") % 8).alias("category"))


@register("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def parse_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@register(r"SELECT doc_id, md5(regexp_replace(text, '[|@#!¡·$€%&()=?¿^*;:,¨´><+]', '_', 'g')) AS cleaned FROM documents")
def clean_str(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(G.cleaned(F.col("text")).cast("binary")).alias("cleaned"))
