"""DuckDB-side definitions of the fixture views, for oracle SQL.

``with_views(sql)`` prefixes a query with the CTEs of every fixture view it
names (dependencies first), so each oracle is one self-contained string
over the pre-registered base tables.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "v_sni": """SELECT * FROM (VALUES
 ('10111','slaughter','AUTOMOBILE',0), ('10112','cutting','BUILDING',1),
 ('10200','fish','FURNITURE',2), ('38110','waste','MACHINERY',3),
 ('38320','recovery','HOUSEHOLD',4)) AS t(sni_code, description, segment, label_pos)""",
    "v_companies": """SELECT c.c_custkey AS company_id,
       lpad(CAST(c.c_custkey AS VARCHAR), 10, '0') AS org_nr,
       concat(c.c_name, CASE c.c_custkey % 3 WHEN 0 THEN ' Aktiebolag'
              WHEN 1 THEN ' Handelsbolag' ELSE '' END) AS name,
       lpad(CAST(c.c_nationkey AS VARCHAR), 4, '0') AS municipality_code,
       n.n_name AS municipality,
       CASE c.c_custkey % 4 WHEN 0 THEN '49' WHEN 1 THEN '31' WHEN 2 THEN '51' ELSE '10' END AS legal_form,
       CASE WHEN c.c_custkey % 13 = 0 THEN '0' ELSE '1' END AS company_status,
       CASE WHEN c.c_custkey % 17 = 0 THEN '0' ELSE '1' END AS registration_status,
       c.c_custkey % 20 AS n_workplaces,
       CASE WHEN c.c_custkey % 11 = 0 THEN list_value(s.sni_code, '10111', '38320')
            WHEN c.c_custkey % 3 = 0 THEN list_value(s.sni_code, '38110')
            ELSE list_value(s.sni_code) END AS branch_codes,
       CASE c.c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN 'a b'
            ELSE concat('http://www.c', CAST(c.c_custkey AS VARCHAR), '.example.',
                 CASE c.c_custkey % 2 WHEN 0 THEN 'com' ELSE 'net' END) END AS url
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN v_sni s ON s.segment = c.c_mktsegment""",
    "v_scraped": """SELECT CASE WHEN page_id % 10 = 9 THEN concat('X', CAST(page_id AS VARCHAR))
            ELSE lpad(CAST(page_id % 40 AS VARCHAR), 10, '0') END AS label,
       url, html AS raw_html, page_id
FROM pages""",
    "v_extracted": """SELECT d.doc_id, d.doc_id % 150 AS company_id,
       CASE WHEN d.doc_id % 300 < 150 THEN TIMESTAMP '2024-01-01 00:00:00'
            ELSE TIMESTAMP '2024-02-01 00:00:00' END AS run_ts,
       d.text AS data
FROM documents d""",
    "v_labelled_docs": """SELECT doc_id, text, n_chars, CASE lang WHEN 'en' THEN '10111' WHEN 'de' THEN '10112'
       WHEN 'fr' THEN '38110' ELSE '38320' END AS true_label
FROM documents""",
    "v_scores": """SELECT d.doc_id, d.true_label, s.sni_code AS label, s.label_pos,
       ((d.doc_id * 7919 + s.label_pos * 104729) % 1000) / 1000.0e0 AS score
FROM v_labelled_docs d CROSS JOIN (SELECT * FROM (VALUES
 ('10111',0), ('10112',1), ('10200',2), ('38110',3), ('38320',4), ('01110',5), ('10891',6), ('13100',7), ('38210',8),
 ('41200',9), ('46390',10), ('56100',11), ('62010',12), ('85520',13)) AS t(sni_code, label_pos)) s""",
    "v_hits": """SELECT lower(name) AS name, company_id, 1 AS rank,
       CASE company_id % 5 WHEN 0 THEN 'https://www.facebook.com/x' WHEN 1 THEN ''
            ELSE concat('https://www.f', CAST(company_id AS VARCHAR), '.example.org') END AS link
FROM v_companies""",
    "v_hrefs": """SELECT c_custkey AS page_id,
       concat('<a href="tel:0', CAST(c_custkey % 10 AS VARCHAR), '-12 34 5', CAST(c_custkey % 3 AS VARCHAR),
              '">t</a><a href="mailto:u', CAST(c_custkey % 50 AS VARCHAR), '@example.org">m</a>',
              '<a href="/om/oss">om</a><a href="/en/about">about</a>') AS html
FROM customer""",
}

_NAME = re.compile(r"\b(v_[a-z_]+)\b")


def _deps(name: str, seen: list[str]) -> None:
    for dep in _NAME.findall(VIEWS[name]):
        if dep != name and dep in VIEWS and dep not in seen:
            _deps(dep, seen)
    if name not in seen:
        seen.append(name)


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of the fixture views it mentions.

    ``extra`` adds query-local CTEs (defined after the fixture views).
    """
    order: list[str] = []
    body = sql + " " + " ".join((extra or {}).values())
    for name in _NAME.findall(body):
        if name in VIEWS:
            _deps(name, order)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in order]
    ctes += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    if not ctes:
        return sql
    head = sql.lstrip()
    m = re.match(r"(?is)with\s+(recursive\s+)?", head)
    if m:  # merge the query's own CTE list into ours
        kw = "WITH RECURSIVE " if m.group(1) else "WITH "
        return kw + ",\n".join(ctes) + ",\n" + head[m.end():]
    return "WITH " + ",\n".join(ctes) + "\n" + sql
