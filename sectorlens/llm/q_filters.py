"""op4: secret scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query, table
from .secrets import ACCESS, ALLOW, ASSIGN, BASE_KINDS, CLASSES, HEX, scan_secrets, span_list


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: str, rank: int, pattern: str) -> str:
    """DuckDB SQL: every match with its start, from the pieces between the matches."""
    q = _quoted(pattern)
    return f"""SELECT r, {rank} AS k, '{kind}' AS kind, v[i] AS v, m[i] AS w, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
  + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
FROM (SELECT r, m, g, v, unnest(range(1, len(m) + 1)) AS i FROM (
  SELECT r, regexp_extract_all(t, {q}) AS m, string_split_regex(t, {q}) AS g,
         regexp_extract_all(t, {q}, {2 if kind == 'assign' else 0}) AS v FROM d) a) b"""


def _oracle() -> str:
    base = " UNION ALL ".join(_matches(k, i, p) for i, (k, p) in enumerate(zip(BASE_KINDS, (ASSIGN, ACCESS, HEX))))
    allow = " AND ".join(f"NOT regexp_matches(w, {_quoted(a)})" for a in ALLOW)
    more = []
    for i, (kind, pattern, size, bits, need) in enumerate(CLASSES, len(BASE_KINDS)):
        window = f"substring(w, j, {size})"
        more.append(f"""SELECT r, {i} AS k, '{kind}' AS kind, s + min(j) - 1 AS s, s + max(j) - 1 + {size} AS e
FROM (SELECT c.*, unnest(range(1, length(w) - {size} + 2)) AS j FROM ({_matches(kind, i, pattern)}) c WHERE {allow}
  AND NOT EXISTS (SELECT 1 FROM b WHERE b.r = c.r AND b.s < c.s + length(c.w) AND c.s < b.e)) x
WHERE list_aggregate(string_split({window}, ''), 'entropy') >= {bits} - 1e-9 AND regexp_matches({window}, '[{need}]')
GROUP BY r, s, w""")
    text = "kind || ':' || s || ':' || e"
    count = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT r, k, kind, s, s + length(w) AS e FROM ({base}) a WHERE kind <> 'assign' OR length(v) >= 6),
a AS (SELECT * FROM b UNION ALL {' UNION ALL '.join(more)}),
nb AS (SELECT r, {count}, string_agg({text}, ',' ORDER BY s, k, e) AS l FROM b GROUP BY r),
na AS (SELECT r, string_agg({text}, ',' ORDER BY s, k, e) AS l FROM a GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)}, sha256(coalesce(nb.l, '')) AS base_sha256,
       coalesce(na.l, '') AS spans FROM d LEFT JOIN nb USING (r) LEFT JOIN na USING (r)"""


@query("op4_secrets", _oracle())
def op4_secrets(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base_spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(F.encode(span_list(F.col("base_spans")), "UTF-8"), 256).alias("base_sha256"),
                        span_list(F.col("spans")).alias("spans"))


@query("op4_secrets_by_piece")
def op4_secrets_by_piece(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), by_piece=True)
    return found.select("doc_id", span_list(F.col("spans")).alias("spans"))
