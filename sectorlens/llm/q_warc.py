"""op3: WARC archives written and read back."""

from __future__ import annotations

from .registry import query, table
from .warc import read_archives, write_archives

ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first_id FROM p),
r AS (SELECT *, CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r
"""


@query("op3_warc", ORACLE)
def op3_warc(spark, sf_dir):
    return read_archives(write_archives(table(spark, sf_dir, "pages"))).drop("url")
