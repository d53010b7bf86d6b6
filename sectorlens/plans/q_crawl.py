"""Queries for joins and crawl/enrichment: J04, J05, J08-J11, W03, O04, H14."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import crawl as C
from ..operators import enrich as N
from ..operators import html as H
from ..sources import fixtures as fx
from .registry import query

_HOST = "lower(regexp_extract({u}, '^(?:[^:/?#]+:)?//(?:[^@/?#]*@)?([^:/?#]*)', 1))"
_REGDOM = "regexp_extract({h}, '([^.]+\\.[^.]+)$', 1)"


def _frontier(spark, sf):
    """Start urls plus depth-1 entries from search hits (duplicated urls included)."""
    c = fx.v_companies(spark, sf)
    seed = C.start_urls(c)
    hits = fx.v_hits(spark, sf).join(c.select("company_id", "org_nr"), "company_id") \
        .filter(F.col("link") != "").select(F.col("org_nr").alias("label"), F.col("link").alias("url"),
                                            F.lit(1).alias("depth"))
    return seed.unionByName(hits)


def _stored(spark, sf):
    c = fx.v_companies(spark, sf)
    return c.filter((F.col("company_id") % 5 == 0) & N.has_url_filter("ONLY")).select("url")


FRONTIER_SQL = """SELECT org_nr AS label, url, 0 AS depth FROM v_companies WHERE regexp_matches(url, '^\\S+$')
UNION ALL SELECT c.org_nr AS label, h.link AS url, 1 AS depth FROM v_hits h JOIN v_companies c ON c.company_id = h.company_id
WHERE h.link <> ''"""
STORED_SQL = "SELECT url FROM v_companies WHERE company_id % 5 = 0 AND regexp_matches(url, '^\\S+$')"


@query("j04_unscraped_frontier",
       """SELECT label, url, depth FROM (
  SELECT label, url, depth, row_number() OVER (PARTITION BY url ORDER BY depth, label) AS rn FROM frontier) f
WHERE rn = 1 AND url NOT IN (SELECT url FROM stored)""", extra={"frontier": FRONTIER_SQL, "stored": STORED_SQL})
def j04(spark, sf):
    return C.unscraped(_frontier(spark, sf), _stored(spark, sf))


@query("o04_scraped_set",
       """SELECT DISTINCT url FROM (SELECT url FROM stored UNION ALL
  SELECT link AS url FROM v_hits WHERE link <> '')""", extra={"stored": STORED_SQL})
def o04(spark, sf):
    new = fx.v_hits(spark, sf).filter(F.col("link") != "").select(F.col("link").alias("url"))
    return C.scraped_set(_stored(spark, sf), new)


def _lookup_urls(spark, sf):
    c = fx.v_companies(spark, sf).filter(N.has_url_filter("ONLY"))
    a = c.select(F.concat(F.col("company_id").cast("string"), F.lit("a")).alias("qid"),
                 F.concat("url", F.lit("/about")).alias("url"))
    b = c.select(F.concat(F.col("company_id").cast("string"), F.lit("b")).alias("qid"),
                 F.regexp_replace("url", "www", "shop").alias("url"))
    return a.unionByName(b)


@query("j05_company_by_url",
       """WITH q AS (
  SELECT concat(CAST(company_id AS VARCHAR), 'a') AS qid, concat(url, '/about') AS url FROM v_companies WHERE regexp_matches(url, '^\\S+$')
  UNION ALL SELECT concat(CAST(company_id AS VARCHAR), 'b') AS qid, replace(url, 'www', 'shop') AS url FROM v_companies WHERE regexp_matches(url, '^\\S+$')),
qh AS (SELECT qid, url, HOSTQ AS host FROM q),
qd AS (SELECT qid, url, host, REGQ AS regdom FROM qh),
c AS (SELECT company_id, HOSTC AS host FROM v_companies WHERE regexp_matches(url, '\\S')),
cd AS (SELECT company_id, host, REGC AS regdom FROM c)
SELECT qd.qid, qd.url, coalesce(
   (SELECT min(company_id) FROM cd WHERE cd.host = qd.host AND qd.host <> ''),
   (SELECT min(company_id) FROM cd WHERE cd.regdom = qd.regdom AND qd.regdom <> '')) AS company_id
FROM qd""".replace("HOSTQ", _HOST.format(u="url")).replace("REGQ", _REGDOM.format(h="host"))
       .replace("HOSTC", _HOST.format(u="url")).replace("REGC", _REGDOM.format(h="host")))
def j05(spark, sf):
    r = N.company_by_url(_lookup_urls(spark, sf), fx.v_companies(spark, sf))
    return r.select("qid", "url", "company_id")


def _loose_urls(spark, sf):
    """Lookups of hosts that are parts of stored ones, of wildcards and of hosts without a suffix."""
    c = fx.v_companies(spark, sf).filter(N.has_url_filter("ONLY"))
    k = F.col("company_id").cast("string")

    def form(tag, url):
        return c.select(F.concat(k, F.lit(tag)).alias("qid"), url.alias("url"))
    return (_lookup_urls(spark, sf).unionByName(form("c", F.concat(F.lit("https://W.c"), k, F.lit(".example.com/x?y"))))
            .unionByName(form("d", F.concat(F.lit("http://tt.//www.c"), k, F.lit(".net"))))
            .unionByName(form("e", F.concat(F.lit("http://w.c"), k, F.lit("xexample.com"))))
            .unionByName(form("f", F.concat(F.lit("http://c"), k)))
            .unionByName(form("g", F.concat(F.lit("http://"), k, F.lit(".se")))))


@query("j05_company_by_url_reference",
       """WITH k AS (SELECT company_id, CAST(company_id AS VARCHAR) AS k, url FROM v_companies WHERE regexp_matches(url, '^\\S+$')),
q AS (SELECT concat(k, 'a') AS qid, concat(url, '/about') AS url FROM k UNION ALL SELECT concat(k, 'b'), replace(url, 'www', 'shop') FROM k
  UNION ALL SELECT concat(k, 'c'), concat('https://W.c', k, '.example.com/x?y') FROM k
  UNION ALL SELECT concat(k, 'd'), concat('http://tt.//www.c', k, '.net') FROM k
  UNION ALL SELECT concat(k, 'e'), concat('http://w.c', k, 'xexample.com') FROM k
  UNION ALL SELECT concat(k, 'f'), concat('http://c', k) FROM k UNION ALL SELECT concat(k, 'g'), concat('http://', k, '.se') FROM k),
h AS (SELECT qid, url, HOSTQ AS host FROM q),
p AS (SELECT *, CASE WHEN host LIKE '%_._%' THEN host ELSE '' END AS full_host, CASE WHEN host LIKE '%_._%' THEN REGQ ELSE '' END AS base FROM h),
d AS (SELECT full_host, base, coalesce((SELECT min(company_id) FROM v_companies c WHERE c.url LIKE '%' || replace(full_host, '.', '_') || '%'),
                           (SELECT min(company_id) FROM v_companies c WHERE c.url LIKE '%' || replace(base, '.', '_') || '%')) AS company_id
      FROM (SELECT DISTINCT full_host, base FROM p) u)
SELECT qid, url, company_id FROM p JOIN d USING (full_host, base)""".replace("HOSTQ", _HOST.format(u="url")).replace(
           "REGQ", _REGDOM.format(h="host")))
def j05_reference(spark, sf):
    r = N.company_by_url_reference(_loose_urls(spark, sf), fx.v_companies(spark, sf))
    return r.select("qid", "url", "company_id")


@query("j08_attach_first_hit",
       """SELECT c.company_id, coalesce(h.link, '') AS link
FROM (SELECT company_id, replace(replace(lower(name), 'aktiebolag', ''), 'handelsbolag', '') AS query FROM v_companies) c
LEFT JOIN (SELECT name, min(link) AS link FROM v_hits WHERE rank = 1 GROUP BY name) h ON h.name = c.query""")
def j08(spark, sf):
    return N.attach_first_hit(fx.v_companies(spark, sf), fx.v_hits(spark, sf)).select("company_id", "link")


@query("j09_bulk_first_hits",
       """SELECT q.pos, q.query, coalesce(h.link, '') AS link
FROM (SELECT company_id AS pos, lower(name) AS query FROM v_companies) q
LEFT JOIN (SELECT name, min(link) AS link FROM v_hits WHERE rank = 1 GROUP BY name) h ON h.name = q.query""")
def j09(spark, sf):
    qs = fx.v_companies(spark, sf).select(F.col("company_id").alias("pos"), F.lower("name").alias("query"))
    return N.bulk_first_hits(qs, fx.v_hits(spark, sf))


# W03 oracle: codes visited in ascending order, each taking up to 100 eligible
# companies not taken before (recursive over the ordered code list).
W03_SQL = """WITH RECURSIVE codes AS (
  SELECT sni_code, row_number() OVER (ORDER BY sni_code) AS k FROM v_sni),
elig AS (SELECT company_id, branch_codes FROM v_companies
         WHERE (url IS NULL OR regexp_matches(url, '^\\s*$')) AND name IS NOT NULL AND name <> ''),
steps(k, taken) AS (
  SELECT 0, CAST([] AS STRUCT(company_id BIGINT, code VARCHAR)[])
  UNION ALL
  SELECT s.k + 1, list_concat(s.taken, (
      SELECT coalesce(list({'company_id': e.company_id, 'code': c.sni_code} ORDER BY e.company_id), [])
      FROM (SELECT e.company_id FROM elig e, codes c2
            WHERE c2.k = s.k + 1 AND list_contains(e.branch_codes, c2.sni_code)
              AND NOT list_contains(list_transform(s.taken, lambda t: t.company_id), e.company_id)
            ORDER BY e.company_id LIMIT 100) e, codes c WHERE c.k = s.k + 1))
  FROM steps s WHERE s.k < (SELECT max(k) FROM codes))
SELECT t.company_id, t.code FROM (
  SELECT unnest(taken) AS t FROM steps WHERE k = (SELECT max(k) FROM codes))"""


@query("w03_serial_code_quota", W03_SQL)
def w03(spark, sf):
    codes = fx.v_sni(spark).select("sni_code")
    return N.serial_code_quota(fx.v_companies(spark, sf), codes, limit=100)


# The same with companies of any url; only those whose lookup fails leave the pool.
_USABLE = """SELECT c.company_id FROM v_companies c
  JOIN (SELECT name, min(link) AS link FROM v_hits WHERE rank = 1 GROUP BY name) h
    ON h.name = replace(replace(lower(c.name), 'aktiebolag', ''), 'handelsbolag', '')
  WHERE h.link <> '' AND NOT EXISTS (SELECT 1 FROM (SELECT unnest([{bl}]) AS d) b WHERE contains(h.link, b.d))""".format(
    bl=", ".join(f"'{d}'" for d in K.URL_BLACKLIST))
W03_REGENERATE_SQL = (W03_SQL.replace("(url IS NULL OR regexp_matches(url, '^\\s*$')) AND ", "")
                      .replace("AND NOT list_contains(list_transform(s.taken, lambda t: t.company_id), e.company_id)",
                               "AND (e.company_id IN (SELECT company_id FROM usable) OR"
                               " NOT list_contains(list_transform(s.taken, lambda t: t.company_id), e.company_id))")
                      .replace("steps(k, taken) AS (", f"usable AS ({_USABLE}),\nsteps(k, taken) AS ("))


@query("w03_regenerating_quota", W03_REGENERATE_SQL)
def w03_regenerate(spark, sf):
    """Lookups that regenerate urls: a company that got one counts again for its later codes."""
    c = fx.v_companies(spark, sf)
    return N.serial_code_quota(c, fx.v_sni(spark).select("sni_code"), limit=100, has_url="BOTH",
                               staying=N.successful_lookups(c, fx.v_hits(spark, sf)))


def _j10_sql():
    body = W03_SQL[len("WITH RECURSIVE "):]
    head, final = body.rsplit("SELECT t.company_id, t.code FROM (", 1)
    processed = "SELECT t.company_id, t.code FROM (" + final
    bl = ", ".join(f"'{d}'" for d in K.URL_BLACKLIST)
    return f"""WITH RECURSIVE {head.rstrip().rstrip(',')},
processed AS ({processed}),
found AS (
  SELECT p.company_id, coalesce(h.link, '') AS link
  FROM (SELECT DISTINCT company_id FROM processed) p JOIN v_companies c ON c.company_id = p.company_id
  LEFT JOIN (SELECT name, min(link) AS link FROM v_hits WHERE rank = 1 GROUP BY name) h
    ON h.name = replace(replace(lower(c.name), 'aktiebolag', ''), 'handelsbolag', ''))
SELECT c.company_id, CASE WHEN f.link IS NOT NULL THEN f.link ELSE c.url END AS url
FROM v_companies c LEFT JOIN found f ON f.company_id = c.company_id
WHERE f.link IS NULL OR (f.link <> '' AND NOT EXISTS (
  SELECT 1 FROM (SELECT unnest([{bl}]) AS d) b WHERE contains(f.link, b.d)))"""


@query("j10_apply_lookup_results", _j10_sql())
def j10(spark, sf):
    c = fx.v_companies(spark, sf)
    processed = N.serial_code_quota(c, fx.v_sni(spark).select("sni_code"), limit=100)
    return N.apply_lookup_results(c, processed, fx.v_hits(spark, sf)).select("company_id", "url")


def _raw_link_pages(spark, sf):
    c = fx.v_companies(spark, sf)
    h = fx.v_hrefs(spark, sf)
    return h.join(c.select(F.col("company_id").alias("page_id"), "org_nr"), "page_id").select(
        "page_id", F.col("org_nr").alias("label"),
        F.concat(F.lit("http://www.c"), F.col("page_id").cast("string"), F.lit(".example.com/start")).alias("url"),
        F.when(F.col("page_id") % 4 == 0, 1).otherwise(0).alias("depth"), "html")


def _link_pages(spark, sf):
    """The parsed pages; dealt over the shuffle's tasks first, as the customers they are made from lie in few row groups."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return H.parse_pages(_raw_link_pages(spark, sf).repartition(tasks, "page_id"), keep=["page_id", "label", "url", "depth"], with_links=True,
                         parts=("anchors",))


def _stored_links(spark, sf):
    c = fx.v_companies(spark, sf)
    return c.filter(F.col("company_id") % 3 == 0).select(
        F.concat(F.lit("http://www.c"), F.col("company_id").cast("string"), F.lit(".example.com/om/oss")).alias("url"))


LINK_PAGES_SQL = """SELECT c.company_id AS page_id, c.org_nr AS label,
  concat('http://www.c', CAST(c.company_id AS VARCHAR), '.example.com/start') AS url,
  CASE WHEN c.company_id % 4 = 0 THEN 1 ELSE 0 END AS depth
FROM v_companies c JOIN customer k ON k.c_custkey = c.company_id"""
DISCOVERED_SQL = """SELECT DISTINCT p.label, concat('http://www.c', CAST(p.page_id AS VARCHAR), '.example.com', x.path) AS url, 1 AS depth
FROM lp p, (SELECT unnest(['/om/oss', '/en/about']) AS path) x WHERE p.depth < 1"""
STORED_LINKS_SQL = "SELECT concat('http://www.c', CAST(company_id AS VARCHAR), '.example.com/om/oss') AS url FROM v_companies WHERE company_id % 3 = 0"


@query("j11_discovered_links",
       "SELECT label, url, depth FROM disc WHERE url NOT IN (SELECT url FROM stl)",
       extra={"lp": LINK_PAGES_SQL, "disc": DISCOVERED_SQL, "stl": STORED_LINKS_SQL})
def j11(spark, sf):
    return C.discovered_links(_link_pages(spark, sf), _stored_links(spark, sf))


@query("h14_next_frontier",
       """SELECT label, url, depth FROM (
  SELECT label, url, depth, row_number() OVER (PARTITION BY url ORDER BY depth, label) AS rn FROM (
    SELECT label, url, depth FROM lp UNION ALL SELECT label, url, depth FROM disc) g) f
WHERE rn = 1 AND url NOT IN (SELECT url FROM stl)""",
       extra={"lp": LINK_PAGES_SQL, "disc": DISCOVERED_SQL, "stl": STORED_LINKS_SQL})
def h14(spark, sf):
    frontier = _raw_link_pages(spark, sf).select("label", "url", "depth")
    return C.next_frontier(frontier, _link_pages(spark, sf), _stored_links(spark, sf), filter_=False)


@query("h14_next_frontier_filtered",
       """SELECT label, url, depth FROM (
  SELECT label, url, depth, row_number() OVER (PARTITION BY url ORDER BY depth, label) AS rn FROM (
    SELECT label, url, depth FROM lp UNION ALL SELECT label, url, depth FROM disc) g
  WHERE NOT contains(url, '/en/')) f
WHERE rn = 1 AND url NOT IN (SELECT url FROM stl)""",
       extra={"lp": LINK_PAGES_SQL, "disc": DISCOVERED_SQL, "stl": STORED_LINKS_SQL})
def h14f(spark, sf):
    frontier = _raw_link_pages(spark, sf).select("label", "url", "depth")
    return C.next_frontier(frontier, _link_pages(spark, sf), _stored_links(spark, sf), filter_=True)
