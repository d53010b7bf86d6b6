"""op11: filter interaction audit."""

from __future__ import annotations

from .audit import audit_filters
from .registry import query, table

ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN least < w.doc_id THEN 16 ELSE 0 END AS mask
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, CAST(step AS INT), 1) AS x,
             CAST(list_sum(list_transform(string_split(substr(filter_order, 1, CAST(step AS INT) - 1), ''),
                  lambda y: CASE WHEN y = '' THEN 0 ELSE CAST(1 << (ascii(y) - 65) AS INT) END)) AS INT) AS before
      FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o) q),
p AS (SELECT *, CAST(1 << (ascii(x) - 65) AS INT) AS own FROM (SELECT filter_order, step, x, coalesce(before, 0) AS before FROM s) q),
r AS (SELECT part, filter_order, step, x,
             sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, p GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r
"""


@query("op11_filter_audit", ORACLE)
def op11_filter_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return audit_filters(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))
