"""SQL (DuckDB) that gives the rows of queries whose results do not depend on a fit."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Windows are compared as joined words (no word holds a blank); a hit word is counted once.
DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS win FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT rid, i, n, item_id FROM dw JOIN bw USING (n, win)),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""

#: Removed windows of one length that touch make one span; what lies between spans is kept.
WORD_REPEATS = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i + 1 : i + 20], ' ') AS win FROM (SELECT rid, w, unnest(range(len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
gone AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY win ORDER BY rid, i) AS k FROM win) WHERE k > 1),
isl AS (SELECT rid, i, sum(CASE WHEN i <= before + 20 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS g FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM gone)),
sp AS (SELECT rid, min(i) AS a, max(i) + 20 AS b FROM isl GROUP BY rid, g),
cut AS (SELECT rid, list({'a': a, 'b': b} ORDER BY a) AS s, sum(b - a) AS removed FROM sp GROUP BY rid),
kept AS (SELECT doc_id, len(w) AS n, coalesce(removed, 0) AS removed,
  CASE WHEN s IS NULL THEN w ELSE flatten(list_transform(range(0, len(s) + 1), lambda k: w[CASE WHEN k = 0 THEN 1 ELSE s[k].b + 1 END : CASE WHEN k = len(s) THEN len(w) ELSE s[k + 1].a END])) END AS kept FROM d LEFT JOIN cut USING (rid))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(removed AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM kept
"""

#: Bytes as pairs of hexadecimal digits. Windows are cut from short parts, as cutting a long text takes time by its length.
BYTE_REPEATS = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT rid, doc_id, a, n, substr(h, 2 * a + 1, 1098) AS p FROM (SELECT rid, doc_id, h, length(h) // 2 - 49 AS n, unnest(range(0, CAST(length(h) // 2 - 49 AS BIGINT), 500)) AS a FROM d WHERE length(h) >= 100)),
win AS (SELECT rid, doc_id, a + i AS i, substr(p, 2 * i + 1, 100) AS win FROM (SELECT rid, doc_id, a, p, unnest(range(CAST(least(500, n - a) AS BIGINT))) AS i FROM part)),
gone AS (SELECT rid, i FROM (SELECT rid, i, rank() OVER (PARTITION BY win ORDER BY doc_id NULLS FIRST) AS k FROM win) WHERE k > 1),
isl AS (SELECT rid, i, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS g FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM gone)),
sp AS (SELECT rid, min(i) AS a, max(i) + 50 AS b FROM isl GROUP BY rid, g),
cut AS (SELECT rid, list({'a': a, 'b': b} ORDER BY a) AS s, sum(b - a) AS removed, count(*) AS spans FROM sp GROUP BY rid),
kept AS (SELECT doc_id, length(h) // 2 AS n, coalesce(removed, 0) AS removed, coalesce(spans, 0) AS spans,
  CASE WHEN s IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(s) + 1), lambda k: substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * s[k].b + 1 END, CASE WHEN k = len(s) THEN length(h) ELSE 2 * s[k + 1].a END - CASE WHEN k = 0 THEN 0 ELSE 2 * s[k].b END)), '') END AS kept FROM d LEFT JOIN cut USING (rid))
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(removed AS BIGINT) AS n_removed, CAST(spans AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256 FROM kept
"""
