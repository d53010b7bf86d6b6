"""op1: embedding near-dedup."""

from __future__ import annotations

from .embeddup import near_duplicates
from .registry import query, table

#: all pairs by brute force
BRUTE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, min(r.c) AS component_id,
       v.vec_id = min(r.c) AS kept
FROM v JOIN r ON r.id = v.vec_id GROUP BY v.vec_id
"""


@query("op1_embedding_near_dedup", BRUTE)
def op1_embedding_near_dedup(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return near_duplicates(vectors).select("vec_id", "n_links", "component_id", "kept")
