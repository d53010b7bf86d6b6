"""op6: benchmark decontamination."""

from __future__ import annotations

from .decontaminate import find_leaks
from .registry import lower_az, query, table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE = rf"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower_az('text')}, '{WORDS}') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all({lower_az('text')}, '{WORDS}') AS w FROM benchmark),
bn AS (SELECT *, least(10, len(w)) AS n FROM bw WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p
      FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
sizes AS (SELECT DISTINCT n FROM q),
dp AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n),
hit AS (SELECT r, dp.n, i, item_id FROM dp JOIN q ON q.n = dp.n AND q.p = array_to_string(w[i:i + dp.n - 1], ' ')),
pos AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""


@query("op6_decontamination", ORACLE)
def op6_decontamination(spark, sf_dir):
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op6_proximity")
def op6_proximity(spark, sf_dir):
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_near", "near_items")
