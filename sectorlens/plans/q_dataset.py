"""Queries for joins, splits and corpora: J01-J03, A01-A06, W01, W02, W05,
W06, F21, F23, T01-T04, O02, O03, M01, E09, E15, E20."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import accumulate as A
from ..operators import dataset as D
from ..operators import sampling as S
from ..session import run_folder, staged
from ..sources import fixtures as fx
from ..sources.tables import table
from .q_html import PAGE_TEXT_SQL, YEAR_DEDUP_CTE, body_cte
from .registry import query

SEP = "\u0001"
FORMS = ["49", "31", "51"]


def extracted(spark, sf):
    """Extracted pages in long form, one row per document of ``v_extracted``."""
    e = fx.v_extracted(spark, sf)
    return e.select("company_id", "run_ts", F.col("doc_id").alias("seq"), F.lit("").alias("url"),
                    F.array(F.lit(True), F.lit(True), F.lit(False)).alias("method"), "data")


# DuckDB side of the same pipeline.
PIPE = {
    "ext": "SELECT doc_id AS seq, company_id, run_ts, data FROM v_extracted",
    "latest": """SELECT e.* FROM ext e JOIN (SELECT company_id, max(run_ts) AS run_ts FROM ext GROUP BY company_id) m
  ON m.company_id = e.company_id AND m.run_ts = e.run_ts""",
    "withurl": "SELECT company_id, branch_codes, branch_codes[1] AS code FROM v_companies WHERE regexp_matches(url, '\\S')",
    "nq": "SELECT code, count(*) AS n FROM withurl GROUP BY code",
    "members": "SELECT * FROM withurl WHERE company_id IN (SELECT company_id FROM latest)",
    "ranked": "SELECT m.*, row_number() OVER (PARTITION BY code ORDER BY company_id) AS r FROM members m",
    "splits": """SELECT r.company_id, r.code, r.branch_codes,
  CASE WHEN r.r = 1 OR r.r <= (q.n * 20) // 100 THEN 'dev'
       WHEN r.r <= (q.n * 20) // 100 + (q.n * 10) // 100 THEN 'test' ELSE 'train' END AS split
FROM ranked r JOIN nq q ON q.code IS NOT DISTINCT FROM r.code""",
    "docs": """SELECT l.company_id, s.split, s.code AS sni_code,
  substring(string_agg(' ' || l.data, '' ORDER BY l.seq), 1, 1000000) AS text
FROM latest l JOIN splits s ON s.company_id = l.company_id GROUP BY l.company_id, s.split, s.code""",
    "corpus": "SELECT company_id, split, sni_code, text, length(text) AS n_chars FROM docs WHERE length(text) >= 300",
}


def _pipe(*names):
    order = ["ext", "latest", "withurl", "nq", "members", "ranked", "splits", "docs", "corpus"]
    need = set()
    deps = {"latest": ["ext"], "nq": ["withurl"], "members": ["withurl", "latest"], "ranked": ["members"],
            "splits": ["ranked", "nq"], "docs": ["latest", "splits"], "corpus": ["docs"]}

    def add(n):
        if n in need:
            return
        need.add(n)
        for d in deps.get(n, []):
            add(d)
    for n in names:
        add(n)
    return {n: PIPE[n] for n in order if n in need}


def _corpus(spark, sf):
    c = fx.v_companies(spark, sf)
    ext = extracted(spark, sf)
    # stage boundary (the divide job writes this table): cut the lineage so
    # the corpus plan starts from the materialised dataset
    ds = staged(D.build_dataset(c, ext), "dataset")
    return D.build_corpus(ds, bounds_from=ds.select("seq"))


@query("j01_pages_to_company",
       """SELECT s.page_id, f.company_id FROM v_scraped s
JOIN (SELECT org_nr, min(company_id) AS company_id FROM v_companies GROUP BY org_nr) f ON f.org_nr = s.label""")
def j01(spark, sf):
    pages = fx.v_scraped(spark, sf).select("label", "url", "page_id")
    return D.attach_companies(pages, fx.v_companies(spark, sf)).select("page_id", "company_id")


@query("j02_unmatched_pages",
       "SELECT page_id, label FROM v_scraped WHERE label NOT IN (SELECT org_nr FROM v_companies)")
def j02(spark, sf):
    return D.unmatched_pages(fx.v_scraped(spark, sf), fx.v_companies(spark, sf)).select("page_id", "label")


@query("j03_code_members_latest",
       """SELECT DISTINCT m.company_id, m.code, strftime(l.run_ts, '%Y-%m-%d %H:%M:%S') AS run_ts
FROM members m JOIN latest l ON l.company_id = m.company_id""", extra=_pipe("members", "latest"))
def j03(spark, sf):
    c = fx.v_companies(spark, sf)
    from ..operators.enrich import has_some_url
    withurl = c.filter(has_some_url("url")).select("company_id", D.primary_code().alias("code"))
    lat = D.latest_runs(extracted(spark, sf)).select("company_id", "run_ts").distinct()
    return withurl.join(lat, "company_id").select("company_id", "code", T.run_ts_string("run_ts").alias("run_ts"))


@query("a01_companies_by_primary_code",
       """SELECT branch_codes[1] AS code, count(*) AS count, min(company_id) AS min_company_id,
       max(company_id) AS max_company_id FROM v_companies WHERE regexp_matches(url, '\\S') GROUP BY branch_codes[1]""")
def a01(spark, sf):
    return D.companies_by_primary_code(fx.v_companies(spark, sf))


@query("a02_run_summary",
       """SELECT company_id, strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run_ts, count(*) AS n_pages,
       CAST(sum(length(data)) AS BIGINT) AS total_chars FROM v_extracted GROUP BY company_id, run_ts""")
def a02(spark, sf):
    r = D.run_summary(extracted(spark, sf))
    return r.select("company_id", T.run_ts_string("run_ts").alias("run_ts"), "n_pages",
                    F.col("total_chars").cast("long").alias("total_chars"))


@query("a01_company_id_blocks",
       """WITH m AS (SELECT branch_codes[1] AS code, company_id FROM v_companies WHERE regexp_matches(url, '\\S')),
r AS (SELECT code, company_id, (row_number() OVER (PARTITION BY code ORDER BY company_id) - 1) // 64 AS block FROM m),
d AS (SELECT *, company_id - lag(company_id) OVER (PARTITION BY code, block ORDER BY company_id) AS delta FROM r)
SELECT code, CAST(block AS INT) AS block, min(company_id) AS first_id, CAST(count(*) AS INT) AS n,
       coalesce(string_agg(CAST(delta AS VARCHAR), ',' ORDER BY company_id), '') AS deltas FROM d GROUP BY code, block""")
def a01_blocks(spark, sf):
    """A01's id lists: every company of a code, in blocks of 64 ids."""
    r = A.company_id_blocks(fx.v_companies(spark, sf), D.primary_code(), block=64)
    return r.select("code", "block", "first_id", "n", F.array_join(F.col("deltas").cast("array<string>"), ",").alias("deltas"))


@query("a02_accumulated_documents",
       """SELECT company_id, strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run_ts, count(*) AS n_pages,
       CAST(sum(length(data) + 1) AS BIGINT) AS total_chars,
       md5(left(string_agg(' ' || data, '' ORDER BY CASE WHEN doc_id % 7 < 4 THEN 1 ELSE 2 END, doc_id), 1000000)) AS text_md5
FROM v_extracted GROUP BY company_id, run_ts""")
def a02_accumulated(spark, sf):
    """Pages pushed in two batches, the first of them twice, read back as documents."""
    path = run_folder(spark, "a02")
    pages = extracted(spark, sf)
    first = pages.where("seq % 7 < 4")
    for name, part in (("first", first), ("first", first), ("second", pages.where("seq % 7 >= 4"))):
        A.accumulate_pages(part, path, name, buckets=8)
    docs = A.accumulated_documents(spark, path)
    return docs.select("company_id", T.run_ts_string("run_ts").alias("run_ts"), "n_pages", "total_chars", F.md5("text").alias("text_md5"))


_EXTRACTED_PAGES_SQL = f"""SELECT c.company_id, c.branch_codes[1] AS code, k.n_chars
FROM ({PAGE_TEXT_SQL}) k JOIN v_scraped s ON s.page_id = k.page_id
JOIN (SELECT org_nr, min(company_id) AS company_id FROM v_companies GROUP BY org_nr) f ON f.org_nr = s.label
JOIN v_companies c ON c.company_id = f.company_id"""


def _extraction(spark, sf):
    return D.extraction_job(fx.v_scraped(spark, sf), fx.v_companies(spark, sf), "2024-03-01 00:00:00")


@query("a03_extraction_stats_per_label",
       "SELECT code, count(*) AS n_urls FROM xp GROUP BY code",
       extra={"body": body_cte(True), "kept": YEAR_DEDUP_CTE, "xp": _EXTRACTED_PAGES_SQL})
def a03(spark, sf):
    per, _ = D.extraction_stats(_extraction(spark, sf))
    return per


@query("a03_extraction_stats_totals",
       """SELECT count(*) AS n_urls, count(DISTINCT code) AS n_labels, CAST(sum(n_chars) AS BIGINT) AS total_length,
       round(sum(n_chars) / count(DISTINCT code), 6) AS avg_length_per_label FROM xp""",
       extra={"body": body_cte(True), "kept": YEAR_DEDUP_CTE, "xp": _EXTRACTED_PAGES_SQL})
def a03t(spark, sf):
    _, tot = D.extraction_stats(_extraction(spark, sf))
    return tot.select("n_urls", "n_labels", F.col("total_length").cast("long").alias("total_length"),
                      F.round("avg_length_per_label", 6).alias("avg_length_per_label"))


@query("a04_corpus_stats",
       """SELECT CASE grouping(split, sni_code) WHEN 1 THEN 'split' WHEN 2 THEN 'label' ELSE 'total' END AS level,
       split, sni_code, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS total_length,
       count(DISTINCT sni_code) AS n_labels, round(sum(n_chars) / count(DISTINCT sni_code), 6) AS average_length_per_label
FROM corpus GROUP BY GROUPING SETS ((split), (sni_code), ())""", extra=_pipe("corpus"))
def a04(spark, sf):
    s = D.corpus_stats(_corpus(spark, sf))
    return s.withColumn("average_length_per_label", F.round("average_length_per_label", 6))


A05_SQL = """SELECT branch_codes[1] AS sni_code, municipality_code, count(*) AS cnt FROM v_companies
WHERE company_status = '1' AND registration_status = '1'
  AND legal_form IN (SELECT DISTINCT legal_form FROM v_companies WHERE legal_form IN ('49', '31', '51'))
GROUP BY branch_codes[1], municipality_code"""


def _a05(spark, sf):
    c = fx.v_companies(spark, sf)
    forms = c.select("legal_form").filter(F.col("legal_form").isin(*FORMS)).distinct()
    return S.counts_by_code_and_municipality(c, forms)


@query("a05_counts_code_municipality", A05_SQL)
def a05(spark, sf):
    return _a05(spark, sf)


W05_SQL = """WITH RECURSIVE ordered AS (
  SELECT sni_code, municipality_code, cnt, row_number() OVER (PARTITION BY sni_code ORDER BY municipality_code) AS k
  FROM cnts),
walk(sni_code, k, t, took) AS (
  SELECT DISTINCT sni_code, CAST(0 AS BIGINT), CAST(0 AS BIGINT), false FROM ordered
  UNION ALL
  SELECT w.sni_code, o.k, CASE WHEN w.t < 50 AND w.t + o.cnt <= 50 THEN w.t + o.cnt ELSE w.t END,
         (w.t < 50 AND w.t + o.cnt <= 50)
  FROM walk w JOIN ordered o ON o.sni_code = w.sni_code AND o.k = w.k + 1)
SELECT o.sni_code, o.municipality_code, o.cnt FROM walk w JOIN ordered o ON o.sni_code = w.sni_code AND o.k = w.k
WHERE w.took"""


@query("w05_budgeted_selection", W05_SQL, extra={"cnts": A05_SQL})
def w05(spark, sf):
    return S.budgeted_selection(_a05(spark, sf), limit=50, seed=None)


@query("w05_sampled_companies",
       "SELECT company_id, org_nr FROM v_companies c JOIN sel s ON s.sni_code = c.branch_codes[1] AND s.municipality_code = c.municipality_code WHERE c.company_status = '1' AND c.registration_status = '1'",
       extra={"cnts": A05_SQL, "sel": W05_SQL})
def w05c(spark, sf):
    sel = S.budgeted_selection(_a05(spark, sf), limit=50, seed=None)
    return S.sampled_companies(fx.v_companies(spark, sf), sel).select("company_id", "org_nr")


@query("a06_fetched_total", "SELECT CAST(coalesce(sum(cnt), 0) AS BIGINT) AS count FROM sel",
       extra={"cnts": A05_SQL, "sel": W05_SQL})
def a06(spark, sf):
    return S.fetched_total(S.budgeted_selection(_a05(spark, sf), limit=50, seed=None))


@query("t03_random_visit_order", W05_SQL.replace(
    "ORDER BY municipality_code) AS k", "ORDER BY md5(concat('42:', municipality_code))) AS k"),
    extra={"cnts": A05_SQL})
def t03(spark, sf):
    """Budgeted selection with municipalities visited in a seeded random order."""
    return S.budgeted_selection(_a05(spark, sf), limit=50, seed=42)


SMALL_CUT = 3000


@query("m01_small_cut",
       f"""SELECT company_id, split, sni_code, length(t) AS n_chars, md5(t) AS text_md5
FROM (SELECT company_id, split, sni_code, substring(text, 1, {SMALL_CUT}) AS t FROM docs) d WHERE length(t) >= 300""",
       extra=_pipe("docs"))
def m01_small(spark, sf):
    """The corpus with a cut that most companies reach: their pages pass through the running length."""
    ds = staged(D.build_dataset(fx.v_companies(spark, sf), extracted(spark, sf)), "dataset")
    c = D.build_corpus(ds, max_chars=SMALL_CUT, bounds_from=ds.select("seq"))
    return c.select("company_id", "split", "sni_code", F.col("n_chars").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("w06_last_code", "SELECT branch_codes[1] AS last_code FROM v_companies ORDER BY company_id DESC LIMIT 1")
def w06(spark, sf):
    return S.last_code(fx.v_companies(spark, sf))


_CODES_SQL = "SELECT DISTINCT sni_code FROM (SELECT sni_code FROM v_sni UNION ALL SELECT branch_codes[1] FROM v_companies)"


def _codes(spark, sf):
    c = fx.v_companies(spark, sf).select(D.primary_code().alias("sni_code"))
    return fx.v_sni(spark).select("sni_code").unionByName(c).distinct()


@query("f21_code_range_resume",
       """SELECT sni_code FROM codes, (SELECT branch_codes[1] AS last FROM v_companies ORDER BY company_id DESC LIMIT 1) l
WHERE sni_code <> l.last AND sni_code >= greatest('01120', l.last) AND sni_code <= '95290'""",
       extra={"codes": _CODES_SQL})
def f21(spark, sf):
    last = S.last_code(fx.v_companies(spark, sf)).first()["last_code"]
    return S.code_range(_codes(spark, sf), last)


@query("t01_codes_ascending", "SELECT sni_code FROM codes WHERE sni_code >= '01120' AND sni_code <= '95290'",
       extra={"codes": _CODES_SQL})
def t01(spark, sf):
    return S.code_range(_codes(spark, sf), None)


@query("t02_newest_company", "SELECT company_id, org_nr FROM v_companies ORDER BY company_id DESC LIMIT 1")
def t02(spark, sf):
    return S.newest(fx.v_companies(spark, sf)).select("company_id", "org_nr")


@query("t04_first_match",
       """SELECT municipality_code, company_id, org_nr FROM (
  SELECT municipality_code, company_id, org_nr, row_number() OVER (PARTITION BY municipality_code ORDER BY company_id) AS rn
  FROM v_companies) WHERE rn = 1""")
def t04(spark, sf):
    c = fx.v_companies(spark, sf).select("municipality_code", "company_id", "org_nr")
    return S.first_match(c, "municipality_code")


@query("w01_latest_run", "SELECT company_id, strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run_ts, seq FROM latest",
       extra=_pipe("latest"))
def w01(spark, sf):
    lat = D.latest_runs(extracted(spark, sf))
    return lat.select("company_id", T.run_ts_string("run_ts").alias("run_ts"), "seq")


@query("w02_stratified_split", "SELECT company_id, code, split FROM splits", extra=_pipe("splits"))
def w02(spark, sf):
    s = D.split_assignment(fx.v_companies(spark, sf), extracted(spark, sf))
    return s.select("company_id", "code", "split")


@query("w02_split_60_25_15",
       """SELECT r.company_id, r.code,
  CASE WHEN r.r = 1 OR r.r <= (q.n * 25) // 100 THEN 'dev'
       WHEN r.r <= (q.n * 25) // 100 + (q.n * 15) // 100 THEN 'test' ELSE 'train' END AS split
FROM ranked r JOIN (SELECT code, count(*) AS n FROM members GROUP BY code) q ON q.code IS NOT DISTINCT FROM r.code""",
       extra=_pipe("ranked"))
def w02b(spark, sf):
    """Split where every company with a url has data (n = members), so all
    three splits occur."""
    c = fx.v_companies(spark, sf)
    ext = extracted(spark, sf)
    members = c.join(ext.select("company_id").distinct(), "company_id", "left_semi")
    s = D.split_assignment(members, ext, pct=(60, 25, 15))
    return s.select("company_id", "code", "split")


@query("w02_stratified_split_clean",
       """SELECT r.company_id, r.code,
  CASE WHEN r.r <= (q.n * 20) // 100 THEN 'dev'
       WHEN r.r <= (q.n * 20) // 100 + (q.n * 10) // 100 THEN 'test' ELSE 'train' END AS split
FROM ranked r JOIN (SELECT code, count(*) AS n FROM members GROUP BY code) q ON q.code IS NOT DISTINCT FROM r.code""",
       extra=_pipe("ranked"))
def w02c(spark, sf):
    s = D.split_assignment(fx.v_companies(spark, sf), extracted(spark, sf), mode="clean")
    return s.select("company_id", "code", "split")


@query("o03_union_splits", "SELECT company_id, split FROM splits", extra=_pipe("splits"))
def o03(spark, sf):
    s = D.split_assignment(fx.v_companies(spark, sf), extracted(spark, sf))
    parts = [s.filter(F.col("split") == k).select("company_id", "split") for k in ("train", "dev", "test")]
    return D.union_splits(*parts)


@query("e09_join_page_texts",
       """SELECT company_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (
  SELECT company_id, substring(string_agg(' ' || data, '' ORDER BY seq), 1, 1000000) AS t FROM latest GROUP BY company_id)""",
       extra=_pipe("latest"))
def e09(spark, sf):
    ext = extracted(spark, sf)
    docs = D.assemble_documents(D.latest_runs(ext), ["company_id"], bounds_from=ext.select("seq"))
    return docs.select("company_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("m01_build_corpus",
       "SELECT company_id, split, sni_code, n_chars, md5(text) AS text_md5 FROM corpus", extra=_pipe("corpus"))
def m01(spark, sf):
    c = _corpus(spark, sf)
    return c.select("company_id", "split", "sni_code", F.col("n_chars").cast("long").alias("n_chars"),
                    F.md5("text").alias("text_md5"))


_CODE_LIST = [r[0] for r in fx.SNI_ROWS]


@query("e15_one_hot_labels",
       "SELECT company_id, split, " + " || ',' || ".join(
           f"'{c}=' || CASE WHEN sni_code = '{c}' THEN '1' ELSE '0' END" for c in sorted(_CODE_LIST))
       + " AS cats FROM corpus", extra=_pipe("corpus"))
def e15(spark, sf):
    c = D.with_cats(_corpus(spark, sf), _CODE_LIST)
    ent = F.array_sort(F.map_entries("cats"))
    return c.select("company_id", "split",
                    F.array_join(F.transform(ent, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))),
                                 ",").alias("cats"))


@query("e20_run_ts_format", "SELECT doc_id, strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run_ts FROM v_extracted")
def e20(spark, sf):
    e = fx.v_extracted(spark, sf)
    return e.select("doc_id", T.run_ts_string("run_ts").alias("run_ts"))


@query("f23_min_length", "SELECT doc_id FROM documents WHERE length(text) >= 150")
def f23(spark, sf):
    return D.filter_min_length(table(spark, sf, "documents"), "text", 150).select("doc_id")


@query("o02_dedup_strings",
       """SELECT doc_id, md5(string_agg(s, chr(1) ORDER BY i)) AS strings_md5, count(*) AS n FROM (
  SELECT doc_id, s, min(i) AS i FROM (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i
    FROM (SELECT doc_id, string_split(text, '. ') AS l FROM documents)) GROUP BY doc_id, s) GROUP BY doc_id""")
def o02(spark, sf):
    d = table(spark, sf, "documents")
    u = F.array_distinct(F.split("text", r"\. "))
    return d.select("doc_id", F.md5(F.array_join(u, SEP)).alias("strings_md5"), F.size(u).cast("long").alias("n"))
