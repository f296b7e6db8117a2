"""Further queries over the driver's tables (masks, sampling, choices, run logs, scalars), registered beside the others."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from boxwright.fixtures import detections, labels
from boxwright.functions import geometry as G
from boxwright.functions import scalars as C
from boxwright.operators import masks as K
from boxwright.operators import runs as U
from boxwright.operators import sampling as P
from boxwright.operators import selection as L
from boxwright.plans.registered import ORACLES, QUERIES, RUNS, WITH, both, images, register, rounded, runs, table

__all__ = ["ORACLES", "QUERIES"]


def md5_number(seed: str, key: str, digits: int = 6) -> str:
    return f"CAST('0x' || substr(md5('{seed}-' || {key}), 1, {digits}) AS BIGINT)"


def order_sql(seed: str) -> str:
    return f"o AS (SELECT o_orderkey AS image_id, row_number() OVER (ORDER BY {md5_number(seed, 'o_orderkey')}, o_orderkey) - 1 AS idx FROM orders), t AS (SELECT count(*) AS n FROM o)"


def grid_sql(source: str, obj: str, cell: int = 20) -> str:
    x0, y0 = f"CAST(floor(x1 / {cell}.0) AS INT)", f"CAST(floor(y1 / {cell}.0) AS INT)"
    return f"SELECT image_id, {obj} AS obj_id, unnest(range({y0}, greatest(CAST(floor(y2 / {cell}.0) AS INT), {y0} + 1))) AS y, {x0} AS x0, greatest(CAST(floor(x2 / {cell}.0) AS INT), {x0} + 1) AS x1 FROM {source}"


MASKS = f"{WITH}, a AS ({grid_sql('gt', 'gt_id')}), b AS ({grid_sql('det', 'det_id')})"


@register(f"""{MASKS}, o AS (SELECT a.image_id, a.obj_id AS a_id, b.obj_id AS b_id, CAST(sum(least(a.x1, b.x1) - greatest(a.x0, b.x0)) AS BIGINT) AS overlap FROM a JOIN b ON a.image_id = b.image_id AND a.y = b.y WHERE least(a.x1, b.x1) > greatest(a.x0, b.x0) GROUP BY ALL),
sa AS (SELECT image_id, obj_id AS a_id, sum(x1 - x0) AS aa FROM a GROUP BY ALL), sb AS (SELECT image_id, obj_id AS b_id, sum(x1 - x0) AS ab FROM b GROUP BY ALL)
SELECT image_id, a_id, b_id, overlap, round(overlap / (aa + ab - overlap + 1e-7::DOUBLE) + 1e-9, 6) AS iou FROM o JOIN sa USING (image_id, a_id) JOIN sb USING (image_id, b_id)""")
def mask_iou(spark, sf_dir):
    gt, det = both(spark, sf_dir)
    return K.mask_iou(K.box_runs(gt, "gt_id", 20), K.box_runs(det, "det_id", 20)).withColumn("iou", F.round(F.col("iou") + 1e-9, 6))


@register(f"{MASKS}, s AS (SELECT image_id, obj_id, CAST(sum(x1 - x0) AS BIGINT) AS area FROM a GROUP BY ALL) SELECT *, CAST(row_number() OVER (PARTITION BY image_id ORDER BY area DESC, obj_id) AS INT) AS layer FROM s")
def mask_layers(spark, sf_dir):
    return K.layers(K.box_runs(labels(spark, sf_dir), "gt_id", 20))


@register(f"""{MASKS}, p AS (SELECT DISTINCT image_id, obj_id, unnest(range(greatest(x0, 0), least(x1, 32))) * 24 + y AS p FROM a WHERE y >= 0 AND y < 24 AND x0 < 32 AND x1 > 0),
i AS (SELECT image_id, obj_id, min(p) AS s, max(p) + 1 AS e FROM (SELECT *, p - row_number() OVER (PARTITION BY image_id, obj_id ORDER BY p) AS g FROM p) GROUP BY image_id, obj_id, g),
j AS (SELECT *, s - coalesce(lag(e) OVER (PARTITION BY image_id, obj_id ORDER BY s), 0) AS gap FROM i)
SELECT image_id, obj_id, string_agg(gap || ' ' || (e - s), ' ' ORDER BY s) || CASE WHEN max(e) < 768 THEN ' ' || (768 - max(e)) ELSE '' END AS counts FROM j GROUP BY image_id, obj_id""")
def mask_rle(spark, sf_dir):
    return K.rle_counts(K.box_runs(labels(spark, sf_dir), "gt_id", 20), 32, 24).withColumn("counts", F.array_join(F.transform("counts", lambda c: c.cast("string")), " "))


@register(f"WITH {order_sql('shard')} SELECT image_id, i % 4 AS shard FROM (SELECT image_id, idx AS i FROM o UNION ALL SELECT image_id, n + idx FROM o, t WHERE idx < (4 - n % 4) % 4)")
def shard_images(spark, sf_dir):
    return P.shards(images(spark, sf_dir), "image_id", 4)


@register(f"""WITH {order_sql('partner')}, d AS (SELECT o.image_id, CAST(slot AS INT) AS slot, {md5_number('partner', "o.image_id || '-' || slot", 12)} % n AS idx FROM o, t, (SELECT unnest(range(3)) AS slot))
SELECT d.image_id, slot, o.image_id AS partner FROM d JOIN o USING (idx)""")
def random_partners(spark, sf_dir):
    return P.partners(images(spark, sf_dir), "image_id", 3)


@register(f"""{WITH}, w AS (SELECT image_id, count(*) AS weight FROM gt GROUP BY image_id),
c AS (SELECT image_id, weight, sum(weight) OVER (ORDER BY {md5_number('draw', 'image_id')}, image_id ROWS UNBOUNDED PRECEDING) AS e FROM w), t AS (SELECT max(e) AS total FROM c),
d AS (SELECT k AS draw, {md5_number('draw', 'k', 12)} % total AS pos FROM (SELECT unnest(range(n)) AS k FROM (SELECT count(*) AS n FROM w)), t)
SELECT draw, image_id FROM d JOIN c ON pos >= e - weight AND pos < e""")
def weighted_draws(spark, sf_dir):
    """As many draws as images, as an epoch takes."""
    weights = labels(spark, sf_dir).groupBy("image_id").agg(F.count("*").alias("weight"))
    return P.weighted_draws(weights, "image_id", "weight", weights.count())


@register(f"{WITH} SELECT image_id, det_id, cls FROM det WHERE cls = (cls + CASE WHEN det_id % 3 = 0 THEN 1 ELSE 0 END) % 8")
def second_stage(spark, sf_dir):
    det = detections(spark, sf_dir)
    second = det.withColumn("cls", ((F.col("cls") + F.when(F.col("det_id") % 3 == 0, 1).otherwise(0)) % 8).cast("int"))
    return L.agreeing(det, second).select("image_id", "det_id", "cls")


@register(f"""{WITH}, k AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_id) - 1 AS slot FROM (SELECT *, row_number() OVER (PARTITION BY image_id, cls ORDER BY conf DESC, det_id) AS c FROM det) WHERE c <= 2)
SELECT i.image_id, CAST(s AS INT) AS slot, coalesce(cls, -1) AS cls, coalesce(conf, 0.0) AS conf, cls IS NOT NULL AS valid FROM (SELECT DISTINCT image_id FROM det) i CROSS JOIN (SELECT unnest(range(4)) AS s) LEFT JOIN k ON k.image_id = i.image_id AND k.slot = s""")
def padded_top(spark, sf_dir):
    return L.padded_top(detections(spark, sf_dir), 2, 4)


@register(f"""{WITH} SELECT image_id, det_id, cls, (x1 + x2) / 2.0::DOUBLE AS x, (y1 + y2) / 2.0::DOUBLE AS y, CAST(x2 - x1 AS DOUBLE) AS w, CAST(y2 - y1 AS DOUBLE) AS h, conf
FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_id) AS k FROM det) WHERE k <= 3""")
def target_rows(spark, sf_dir):
    return L.target_rows(detections(spark, sf_dir), 3)


@register(f"""{WITH} SELECT image_id, gt_id FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY (x2 - x1) * (y2 - y1), gt_id) AS k, count(*) OVER (PARTITION BY image_id) AS n FROM gt) WHERE k <= round_even(n * 0.5::DOUBLE, 0)""")
def smallest_half(spark, sf_dir):
    return L.smallest_half(labels(spark, sf_dir), "gt_id").select("image_id", "gt_id")


@register(f"""{WITH}, m AS (SELECT image_id, gt_id, 640 - x2 AS m_x1, y1 AS m_y1, 640 - x1 AS m_x2, y2 AS m_y2 FROM gt)
SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM gt g WHERE g.image_id = m.image_id
  AND greatest(least(g.x2, m_x2) - greatest(g.x1, m_x1), 0) * greatest(least(g.y2, m_y2) - greatest(g.y1, m_y1), 0) / ((g.x2 - g.x1) * (g.y2 - g.y1) + 1e-7::DOUBLE) >= 0.3)""")
def pasteable(spark, sf_dir):
    return L.pasteable(labels(spark, sf_dir), "gt_id", 640)


@register(f"{RUNS} SELECT run_id, min(epoch) AS epoch, fit FROM r WHERE (run_id, fit) IN (SELECT run_id, max(fit) FROM r GROUP BY run_id) GROUP BY run_id, fit")
def best_generation(spark, sf_dir):
    return U.best_row(runs(spark, sf_dir))


@register(f"{RUNS}, b AS (SELECT run_id, max(fit) AS top FROM r GROUP BY run_id), e AS (SELECT run_id, min(epoch) AS e FROM r JOIN b USING (run_id) WHERE fit = top GROUP BY run_id) SELECT run_id, epoch, fit FROM r JOIN e USING (run_id) WHERE epoch <= e")
def until_best(spark, sf_dir):
    return U.until_best(runs(spark, sf_dir)).select("run_id", "epoch", "fit")


@register(f"""{RUNS}, k AS (SELECT *, count(*) OVER (PARTITION BY run_id) AS n, epoch_us(ts) AS us FROM r)
SELECT run_id, epoch, us - min(us) OVER (PARTITION BY run_id) AS elapsed FROM k WHERE epoch > 2 AND epoch <= n - 1""")
def trimmed_log(spark, sf_dir):
    return U.trimmed(runs(spark, sf_dir).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))), 2, 1, "us").select("run_id", "epoch", "elapsed")


_KERNEL = [math.exp(-0.5 * (k / 3) ** 2) for k in range(-12, 13)]


@register(f"""{RUNS}, n AS (SELECT run_id, count(*) AS n FROM r GROUP BY run_id), g AS (SELECT * FROM (VALUES {", ".join(f"({k - 12}, {v / sum(_KERNEL)!r}::DOUBLE)" for k, v in enumerate(_KERNEL))}) AS t(k, g)),
p AS (SELECT r.run_id, r.epoch, n, g, ((r.epoch - 1 + k) % (2 * n) + 2 * n) % (2 * n) AS pos FROM r JOIN n USING (run_id) CROSS JOIN g)
SELECT p.run_id, p.epoch, round(sum(p.g * r.fit) + 1e-9, 6) AS smooth FROM p JOIN r ON r.run_id = p.run_id AND r.epoch = CASE WHEN pos < n THEN pos + 1 ELSE 2 * n - pos END GROUP BY p.run_id, p.epoch""")
def gaussian_smooth(spark, sf_dir):
    return U.gaussian(runs(spark, sf_dir), "fit").withColumn("smooth", F.round(F.col("smooth") + 1e-9, 6))


@register(f"{RUNS} SELECT run_id, epoch, round(0.1::DOUBLE + (0.01::DOUBLE - 0.1::DOUBLE) * greatest(0.0, least(1.0, (epoch - 1) / 9.0::DOUBLE)) + 1e-9, 6) AS rate FROM r")
def warmup_rate(spark, sf_dir):
    return runs(spark, sf_dir).select("run_id", "epoch", F.round(C.interpolated(F.col("epoch"), 1, 10, 0.1, 0.01) + 1e-9, 6).alias("rate"))


@register("""WITH u AS (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(len(embedding))) AS k FROM embeddings),
e AS (SELECT vec_id, CAST(k AS INT) AS k, CAST(v AS DOUBLE) AS x, CASE WHEN k = label THEN 0.95::DOUBLE ELSE 0.05::DOUBLE END AS y FROM u),
l AS (SELECT *, greatest(x, 0) - x * y + ln(1 + exp(-abs(x))) AS b, 1 / (1 + exp(-x)) AS p FROM e)
SELECT vec_id, k, round(b + 1e-9, 6) AS bce, round(b * (y * 0.25 + (1 - y) * 0.75) * pow(1 - (y * p + (1 - y) * (1 - p)), 1.5) + 1e-9, 6) AS focal,
round(b * (y * 0.25 + (1 - y) * 0.75) * pow(abs(y - p), 1.5) + 1e-9, 6) AS quality_focal, round(b * (1 - exp((p - y - 1) / (0.05 + 1e-4))) + 1e-9, 6) AS blurred FROM l""")
def loss_terms(spark, sf_dir):
    high, low = C.smoothed_targets()
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("k", "v"))
    x, y = F.col("v").cast("double"), F.when(F.col("k") == F.col("label"), F.lit(high)).otherwise(F.lit(low))
    return rows.select("vec_id", "k", *rounded(["bce", "focal", "quality_focal", "blurred"], [f(x, y) for f in (C.bce, C.focal, C.quality_focal, C.blurred_bce)]))


@register(f"""{WITH}, v AS (SELECT *, CASE det_id % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.83::DOUBLE ELSE 0.67::DOUBLE END AS s, det_id % 3 = 1 AS lr FROM det), u AS (SELECT image_id, det_id, lr, x1 / s AS x1, y1 / s AS y1, x2 / s AS x2, y2 / s AS y2 FROM v)
SELECT image_id, det_id, round(CASE WHEN lr THEN 640 - x2 ELSE x1 END + 1e-9, 6) AS x1, round(y1 + 1e-9, 6) AS y1, round(CASE WHEN lr THEN 640 - x1 ELSE x2 END + 1e-9, 6) AS x2, round(y2 + 1e-9, 6) AS y2 FROM u""")
def unscaled_views(spark, sf_dir):
    view = F.col("det_id") % 3
    scale = F.when(view == 0, 1.0).when(view == 1, 0.83).otherwise(0.67)
    out = C.unscaled_view(G.columns(), scale, F.when(view == 1, 2).otherwise(0), 640.0, 480.0)
    return detections(spark, sf_dir).select("image_id", "det_id", *rounded(["x1", "y1", "x2", "y2"], out))


@register("SELECT doc_id, octet_length(encode(text)) = length(text) AS ascii, regexp_matches(text, '[一-鿿]') AS chinese FROM documents")
def text_marks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", C.is_ascii(F.col("text")).alias("ascii"), C.is_chinese(F.col("text")).alias("chinese"))


@register(r"SELECT page_id, url_decode(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1)) AS name FROM pages")
def url_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.url_name(F.col("url")).alias("name"))


@register("SELECT p_partkey, CAST('0x' || substr(md5(p_name), 1, 2) AS INT) AS r, CAST('0x' || substr(md5(p_name), 3, 2) AS INT) AS g, CAST('0x' || substr(md5(p_name), 5, 2) AS INT) AS b FROM part")
def colour_codes(spark, sf_dir):
    code = F.concat(F.lit("#"), F.substring(F.md5(F.col("p_name")), 1, 6))
    return table(spark, sf_dir, "part").select("p_partkey", *(c.alias(n) for n, c in zip("rgb", C.hex_rgb(code), strict=True)))
