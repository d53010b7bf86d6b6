"""Queries for H01-H15 (HTML extraction) and the text functions E01-E10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import html as H
from ..operators.dataset import extraction_job
from ..sources import fixtures as fx
from ..sources.tables import table
from .registry import query

SEP = "\u0001"

# ---------------------------------------------------------------------------------
# DuckDB building blocks. RE2 classes are ASCII, so Unicode word characters are
# spelled out; entities are decoded in one left-to-right pass via a placeholder.


def _decode(s: str) -> str:
    x = f"replace(replace({s}, '&amp;', chr(1)), '&amp', chr(1))"
    x = f"replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
    return f"replace({x}, chr(1), '&')"


def _strip(s: str) -> str:
    return f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"


CLEAN_SQL = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
             "regexp_replace({t}, '\\s{{2,}}', '', 'g'), '\\|+', '', 'g'), '\\n+', '', 'g'), '\\t+', '', 'g'), "
             "'\\r+', '', 'g'), '#[\\pL\\pM\\p{{Nd}}_]+', '', 'g'), "
             "'[\\x{{24C2}}-\\x{{10FFFF}}\\x{{200D}}\\x{{23CF}}\\x{{23E9}}\\x{{231A}}]+', '', 'g')")


def clean_sql(t: str) -> str:
    return CLEAN_SQL.format(t=t)


def _marked(drop_links: bool) -> str:
    h = "html"
    h = f"regexp_replace({h}, '(?s)<script[^>]*>.*?</script>', '<x>', 'g')"
    h = f"regexp_replace({h}, '(?s)<style[^>]*>.*?</style>', '<x>', 'g')"
    h = f"regexp_replace({h}, '(?s)<!--.*?-->', '<x>', 'g')"
    if drop_links:
        h = f"regexp_replace({h}, '(?s)<a\\s[^>]*>.*?</a>', '<x>', 'g')"
    return h


def body_cte(drop_links: bool) -> str:
    """(page_id, i, s): stripped non-empty text strings of every page."""
    return f"""SELECT page_id, i, s FROM (
  SELECT page_id, generate_subscripts(parts, 1) AS i, {_strip(_decode('unnest(parts)'))} AS s
  FROM (SELECT page_id, regexp_split_to_array({_marked(drop_links)}, '<[^>]*>') AS parts FROM pages))
WHERE s <> ''"""


# year filter (reference): inside each run of consecutive year-strings the 1st,
# 3rd, 5th... are dropped; then first-occurrence de-duplication.
YEAR_DEDUP_CTE = """SELECT page_id, s, min(i) AS i FROM (
  SELECT page_id, i, s, y,
         row_number() OVER (PARTITION BY page_id, y, grp ORDER BY i) AS pos
  FROM (SELECT page_id, i, s, y, i - row_number() OVER (PARTITION BY page_id, y ORDER BY i) AS grp
        FROM (SELECT page_id, i, s, regexp_matches(s, '^[0-9]{4}') AS y FROM body)))
WHERE NOT (y AND pos % 2 = 1)
GROUP BY page_id, s"""

PAGE_TEXT_SQL = f"""SELECT p.page_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (
  SELECT p.page_id, {clean_sql("coalesce(b.raw, '')")} AS t
  FROM pages p LEFT JOIN (SELECT page_id, string_agg(s || ' ', '' ORDER BY i) AS raw FROM kept GROUP BY page_id) b
  ON p.page_id = b.page_id) p"""


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _strings_out(df, arr):
    return df.select("page_id", F.size(arr).cast("long").alias("n_strings"),
                     F.md5(F.array_join(arr, SEP)).alias("strings_md5"))


STRINGS_SQL = f"""SELECT p.page_id, coalesce(n, 0) AS n_strings, md5(coalesce(j, '')) AS strings_md5
FROM pages p LEFT JOIN (SELECT page_id, count(*) AS n, string_agg(s, chr(1) ORDER BY i) AS j FROM body GROUP BY page_id) b
ON p.page_id = b.page_id"""


@query("h01_parse_pages",
       """SELECT page_id, true AS ok, len(regexp_extract_all(html, '<a\\s[^>]*href="', 0)) AS n_anchors FROM pages""")
def h01(spark, sf):
    p = H.parse_pages(_pages(spark, sf), "html", "url", keep=["page_id"], parts=("anchors",))
    return p.select("page_id", "ok", F.size("anchors").cast("long").alias("n_anchors"))


@query("h02_body_strings", STRINGS_SQL, extra={"body": body_cte(False)})
def h02(spark, sf):
    p = H.parse_pages(_pages(spark, sf), keep=["page_id"], parts=("nodes",))
    return _strings_out(p, H.body_strings("nodes"))


@query("h03_drop_links", STRINGS_SQL, extra={"body": body_cte(True)})
def h03(spark, sf):
    p = H.parse_pages(_pages(spark, sf), keep=["page_id"], parts=("nodes",))
    return _strings_out(p, H.body_strings("nodes", drop_links=True))


@query("h05_drop_scripts", STRINGS_SQL, extra={"body": body_cte(False)})
def h05(spark, sf):
    p = H.parse_pages(_pages(spark, sf), keep=["page_id"], parts=("nodes",))
    return _strings_out(p, H.body_strings("nodes", drop_scripts=True))


# Cookie banners are built from document columns (the pages have none).
COOKIE_HTML_SQL = """SELECT doc_id AS page_id, concat('<div class="',
   CASE doc_id % 4 WHEN 0 THEN 'cookie-bar' WHEN 1 THEN 'cooki' WHEN 2 THEN 'x cookies' ELSE 'main' END,
   '">', source, '</div><span class="cookie">', lang, '</span><p>', CAST(n_chars AS VARCHAR), '</p>') AS html
FROM documents"""


def _cookie_pages(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id") % 4
    cls = (F.when(k == 0, "cookie-bar").when(k == 1, "cooki").when(k == 2, "x cookies").otherwise("main"))
    html = F.concat(F.lit('<div class="'), cls, F.lit('">'), F.col("source"),
                    F.lit('</div><span class="cookie">'), F.col("lang"), F.lit("</span><p>"),
                    F.col("n_chars").cast("string"), F.lit("</p>"))
    return d.select(F.col("doc_id").alias("page_id"), html.alias("html"))


@query("h04_drop_cookie_divs",
       """SELECT page_id, CASE WHEN page_id % 4 IN (0, 2) THEN concat(lang, chr(1), CAST(n_chars AS VARCHAR))
              ELSE concat(source, chr(1), lang, chr(1), CAST(n_chars AS VARCHAR)) END AS strings
FROM (SELECT doc_id AS page_id, source, lang, n_chars FROM documents)""")
def h04(spark, sf):
    p = H.parse_pages(_cookie_pages(spark, sf), url_col=None, keep=["page_id"], parts=("nodes",))
    return p.select("page_id", F.array_join(H.body_strings("nodes", drop_cookies=True), SEP).alias("strings"))


# Nested paragraphs, built from document columns.
@query("h06_paragraphs",
       """SELECT doc_id AS page_id,
       concat(lang, source, ' ', chr(1), source, ' ', chr(1), CAST(n_chars AS VARCHAR)) AS paragraphs
FROM documents""")
def h06(spark, sf):
    d = table(spark, sf, "documents")
    html = F.concat(F.lit("<p>"), F.col("lang"), F.lit("<p>"), F.col("source"), F.lit(" </p></p><p>"),
                    F.col("n_chars").cast("string"), F.lit("</p>"))
    p = H.parse_pages(d.select(F.col("doc_id").alias("page_id"), html.alias("html")), url_col=None,
                      keep=["page_id"], parts=("paras",))
    return p.select("page_id", F.array_join(H.paragraph_strings("paras"), SEP).alias("paragraphs"))


META_SQL = """SELECT doc_id AS page_id, concat(source, chr(1)) AS meta_filtered,
       concat(source, chr(1), lang, chr(1)) AS meta_all FROM documents"""


@query("h07_meta_strings", META_SQL)
def h07(spark, sf):
    d = table(spark, sf, "documents")
    html = F.concat(F.lit('<meta property="og:title" content="'), F.col("source"),
                    F.lit('"><meta name="keywords" content="'), F.col("lang"),
                    F.lit('"><meta name="description"><meta charset="utf-8">'))
    p = H.parse_pages(d.select(F.col("doc_id").alias("page_id"), html.alias("html")), url_col=None,
                      keep=["page_id"], parts=("metas",))
    return p.select("page_id", F.array_join(H.meta_strings("metas", True), SEP).alias("meta_filtered"),
                    F.array_join(H.meta_strings("metas", False), SEP).alias("meta_all"))


# H07 / H09 with the body left out: metas below links and cookie divs stay; with it they go.
@query("h09_meta_only",
       """SELECT doc_id AS page_id, md5(concat(source, ' ', lang, ' ')) AS meta_md5, md5(concat('kx ', source, ' ')) AS both_md5
FROM documents""")
def h09m(spark, sf):
    d = table(spark, sf, "documents")
    html = F.concat(F.lit('kx<meta name="title" content="'), F.col("source"), F.lit('"><a href="/x">link<meta name="description" content="'),
                    F.col("lang"), F.lit('"></a>'))
    p = H.parse_pages(d.select(F.col("doc_id").alias("page_id"), html.alias("html")), url_col=None, keep=["page_id"],
                      parts=("nodes", "metas"))
    return p.select("page_id", F.md5(H.page_text(extract_body=False)).alias("meta_md5"), F.md5(H.page_text()).alias("both_md5"))


# Sentences of every document, some prefixed with a year.
def _year_lists(spark, sf):
    d = table(spark, sf, "documents")
    sents = F.split(F.col("text"), r"\. ")
    tagged = F.transform(sents, lambda s, i: F.when((F.col("doc_id") + i) % 3 != 0,
                                                   F.concat(F.lit("20"), F.lpad((i % 100).cast("string"), 2, "0"),
                                                            F.lit(" "), s)).otherwise(s))
    return d.select("doc_id", tagged.alias("l"))


YEAR_LIST_SQL = """SELECT doc_id, i, CASE WHEN (doc_id + i - 1) % 3 <> 0
       THEN concat('20', lpad(CAST((i - 1) % 100 AS VARCHAR), 2, '0'), ' ', s) ELSE s END AS s
FROM (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i
      FROM (SELECT doc_id, string_split(text, '. ') AS l FROM documents))"""


@query("h08_year_filter",
       """SELECT doc_id, coalesce(string_agg(CASE WHEN NOT (y AND pos % 2 = 1) THEN s END, chr(1) ORDER BY i), '') AS kept_ref,
       coalesce(string_agg(CASE WHEN NOT y THEN s END, chr(1) ORDER BY i), '') AS kept_clean
FROM (SELECT doc_id, i, s, y, row_number() OVER (PARTITION BY doc_id, y, grp ORDER BY i) AS pos
      FROM (SELECT doc_id, i, s, y, i - row_number() OVER (PARTITION BY doc_id, y ORDER BY i) AS grp
            FROM (SELECT doc_id, i, s, regexp_matches(s, '^[0-9]{4}') AS y FROM ylist)))
GROUP BY doc_id""", extra={"ylist": YEAR_LIST_SQL})
def h08(spark, sf):
    y = _year_lists(spark, sf)
    return y.select("doc_id", F.array_join(H.drop_year_strings(F.col("l"), "reference"), SEP).alias("kept_ref"),
                    F.array_join(H.drop_year_strings(F.col("l"), "clean"), SEP).alias("kept_clean"))


@query("e10_year_prefix",
       """SELECT doc_id, CAST(sum(CASE WHEN regexp_matches(s, '^[0-9]{4}') THEN 1 ELSE 0 END) AS BIGINT) AS n_year,
       CAST(count(*) AS BIGINT) AS n FROM ylist GROUP BY doc_id""", extra={"ylist": YEAR_LIST_SQL})
def e10(spark, sf):
    y = _year_lists(spark, sf)
    return y.select("doc_id", F.size(F.filter("l", lambda s: T.starts_with_year(s))).cast("long").alias("n_year"),
                    F.size("l").cast("long").alias("n"))


@query("h09_page_text", PAGE_TEXT_SQL, extra={"body": body_cte(True), "kept": YEAR_DEDUP_CTE})
def h09(spark, sf):
    p = H.parse_pages(_pages(spark, sf), keep=["page_id"], parts=("nodes", "metas")).filter("ok")
    t = T.truncate(H.page_text(filter_=True, p_only=False, extract_meta=True, extract_body=True))
    return p.select("page_id", t.alias("t")).select("page_id", F.length("t").cast("long").alias("n_chars"),
                                                   F.md5("t").alias("text_md5"))


@query("h09_page_text_unfiltered",
       """SELECT p.page_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (
  SELECT p.page_id, coalesce(b.raw, '') AS t
  FROM pages p LEFT JOIN (SELECT page_id, string_agg(s || ' ', '' ORDER BY i) AS raw FROM body GROUP BY page_id) b
  ON p.page_id = b.page_id) p""", extra={"body": body_cte(False)})
def h09u(spark, sf):
    p = H.parse_pages(_pages(spark, sf), keep=["page_id"], parts=("nodes", "metas")).filter("ok")
    t = H.page_text(filter_=False, extract_meta=True, extract_body=True)
    return p.select("page_id", t.alias("t")).select("page_id", F.length("t").cast("long").alias("n_chars"),
                                                   F.md5("t").alias("text_md5"))


# E01-E07, H10 on document texts.
_E = [("e01_delete_multi_space", T.delete_multi_space, "'\\s{2,}'"),
      ("e02_delete_pipes", T.delete_pipes, "'\\|+'"),
      ("e03_delete_newlines", T.delete_newlines, "'\\n+'"),
      ("e04_delete_tabs", T.delete_tabs, "'\\t+'"),
      ("e05_delete_carriage_returns", T.delete_carriage_returns, "'\\r+'"),
      ("e06_delete_hashtags", T.delete_hashtags, "'#[\\pL\\pM\\p{Nd}_]+'"),
      ("e07_delete_symbols", T.delete_symbols,
       "'[\\x{24C2}-\\x{10FFFF}\\x{200D}\\x{23CF}\\x{23E9}\\x{231A}]+'")]


def _e_query(name, fn, pattern):
    @query(name, f"""SELECT doc_id, md5(regexp_replace(text, {pattern}, '', 'g')) AS text_md5,
       length(regexp_replace(text, {pattern}, '', 'g')) AS n_chars FROM documents""")
    def q(spark, sf):
        d = table(spark, sf, "documents")
        t = fn("text")
        return d.select("doc_id", F.md5(t).alias("text_md5"), F.length(t).cast("long").alias("n_chars"))
    return q


for _n, _f, _p in _E:
    _e_query(_n, _f, _p)


@query("h10_clean_chars",
       f"""SELECT doc_id, md5({clean_sql('text')}) AS text_md5, length({clean_sql('text')}) AS n_chars FROM documents""")
def h10(spark, sf):
    d = table(spark, sf, "documents")
    t = T.clean_chars("text")
    return d.select("doc_id", F.md5(t).alias("text_md5"), F.length(t).cast("long").alias("n_chars"))


@query("h10_clean_chars_clean_mode",
       "SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars FROM (SELECT doc_id, trim(regexp_replace(regexp_replace("
       "regexp_replace(text, '#[\\pL\\pM\\p{Nd}_]+', '', 'g'), '" + T.emoji_class() + "', '', 'g'), "
       "'[\\s|]+', ' ', 'g')) AS t FROM documents)")
def h10c(spark, sf):
    d = table(spark, sf, "documents")
    t = T.clean_chars("text", mode="clean")
    return d.select("doc_id", F.md5(t).alias("text_md5"), F.length(t).cast("long").alias("n_chars"))


@query("e08_truncate",
       """SELECT doc_id, length(substring(text, 1, 1000000)) AS n_chars, md5(substring(text, 1, 1000000)) AS text_md5
FROM documents""")
def e08(spark, sf):
    d = table(spark, sf, "documents")
    t = T.truncate("text")
    return d.select("doc_id", F.length(t).cast("long").alias("n_chars"), F.md5(t).alias("text_md5"))


# Contact links built from customer columns.
@query("h11_phone_numbers",
       """SELECT page_id, concat('0', CAST(page_id % 10 AS VARCHAR), '1234', '5', CAST(page_id % 3 AS VARCHAR)) AS phones
FROM v_hrefs""")
def h11(spark, sf):
    p = H.parse_pages(fx.v_hrefs(spark, sf), url_col=None, keep=["page_id"], parts=("anchors",))
    return p.select("page_id", F.array_join(H.phone_numbers("anchors"), ",").alias("phones"))


@query("h12_email_addresses",
       """SELECT page_id, concat('u', CAST(page_id % 50 AS VARCHAR), '@example.org') AS emails FROM v_hrefs""")
def h12(spark, sf):
    p = H.parse_pages(fx.v_hrefs(spark, sf), url_col=None, keep=["page_id"], parts=("anchors",))
    return p.select("page_id", F.array_join(H.email_addresses("anchors"), ",").alias("emails"))


@query("e21_strip_dash_space",
       """SELECT page_id, replace(replace(concat('0', CAST(page_id % 10 AS VARCHAR), '-12 34 5', CAST(page_id % 3 AS VARCHAR)), '-', ''), ' ', '') AS phone
FROM v_hrefs""")
def e21(spark, sf):
    h = fx.v_hrefs(spark, sf)
    raw = F.regexp_extract("html", r'href="tel:([^"]*)"', 1)
    return h.select("page_id", T.strip_dash_space(raw).alias("phone"))


def _linked_pages(spark, sf):
    h = fx.v_hrefs(spark, sf)
    return h.select("page_id", F.concat(F.lit("http://www.c"), F.col("page_id").cast("string"),
                                        F.lit(".example.com/start")).alias("url"), "html")


@query("h13_absolute_links",
       """SELECT page_id, concat('tel:0', CAST(page_id % 10 AS VARCHAR), '-12 34 5', CAST(page_id % 3 AS VARCHAR),
       ',http://www.c', CAST(page_id AS VARCHAR), '.example.com/om/oss',
       ',http://www.c', CAST(page_id AS VARCHAR), '.example.com/en/about') AS links FROM v_hrefs""")
def h13(spark, sf):
    p = H.parse_pages(_linked_pages(spark, sf), keep=["page_id"], with_links=True, parts=())
    return p.select("page_id", F.array_join("links", ",").alias("links"))


@query("h13_links_regex_path",
       """SELECT page_id, CAST(len(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS BIGINT) AS n_links,
       md5(array_to_string(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1), ',')) AS links_md5 FROM pages""")
def h13r(spark, sf):
    p = _pages(spark, sf)
    hr = H.hrefs_by_regex("html")
    return p.select("page_id", F.size(hr).cast("long").alias("n_links"), F.md5(F.array_join(hr, ",")).alias("links_md5"))


@query("h15_extraction_job_clean",
       f"""SELECT c.company_id, k.page_id AS seq, k.n_chars, k.text_md5, s.url
FROM ({PAGE_TEXT_SQL}) k JOIN v_scraped s ON s.page_id = k.page_id
JOIN (SELECT org_nr, min(company_id) AS company_id FROM v_companies GROUP BY org_nr) f ON f.org_nr = s.label
JOIN v_companies c ON c.company_id = f.company_id""",
       extra={"body": body_cte(True), "kept": YEAR_DEDUP_CTE})
def h15c(spark, sf):
    x = extraction_job(fx.v_scraped(spark, sf), fx.v_companies(spark, sf), "2024-03-01 00:00:00", mode="clean")
    return x.select("company_id", "seq", F.length("data").cast("long").alias("n_chars"), F.md5("data").alias("text_md5"),
                    "url")


@query("h15_extraction_job",
       f"""SELECT c.company_id, k.page_id AS seq, k.n_chars, k.text_md5, c.url
FROM ({PAGE_TEXT_SQL}) k JOIN v_scraped s ON s.page_id = k.page_id
JOIN (SELECT org_nr, min(company_id) AS company_id FROM v_companies GROUP BY org_nr) f ON f.org_nr = s.label
JOIN v_companies c ON c.company_id = f.company_id""",
       extra={"body": body_cte(True), "kept": YEAR_DEDUP_CTE})
def h15(spark, sf):
    x = extraction_job(fx.v_scraped(spark, sf), fx.v_companies(spark, sf), "2024-03-01 00:00:00")
    return x.select("company_id", "seq", F.length("data").cast("long").alias("n_chars"), F.md5("data").alias("text_md5"), "url")
