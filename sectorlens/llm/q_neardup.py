"""op5: MinHash near-dedup."""

from __future__ import annotations

from .neardup import near_duplicates
from .registry import lower_az, query, table

ORACLE = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lower_az('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS g
      FROM (SELECT doc_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(c) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN m ON m.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query("op5_minhash_near_dedup", ORACLE)
def op5_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
