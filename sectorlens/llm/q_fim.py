"""op13: fill-in-middle transformation."""

from __future__ import annotations

from pyspark.sql import functions as F

from .fim import fill_in_middle, restore
from .registry import query, table

ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b FROM u),
p AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                     WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(w[1:a], '') AS head, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS tail FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(head) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
                        ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""


@query("op13_fill_in_middle", ORACLE)
def op13_fill_in_middle(spark, sf_dir):
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))
