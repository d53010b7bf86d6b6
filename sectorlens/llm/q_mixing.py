"""op10: mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from .mixing import mix_plan
from .registry import query, table

ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 12) AS BIGINT)
                    / 281474976710656.0::DOUBLE AS u
           FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM p),
f AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
                  ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                / sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
c AS (SELECT *, level * w > 3 * source_size AS is_full FROM f),
m AS (SELECT *, max(CASE WHEN NOT is_full THEN level END) OVER () AS common FROM c),
t AS (SELECT source, source_size, least(CASE WHEN is_full OR common IS NULL THEN CAST(3 * source_size AS DOUBLE)
                                             ELSE common * w END, CAST(3 * source_size AS DOUBLE)) AS target FROM m),
x AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
      FROM d LEFT JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x
"""


@query("op10_mixing", ORACLE)
def op10_mixing(spark, sf_dir):
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("long").alias("taken"))
