"""Queries for the register builder and filters: F01-F25, P01-P06, O01, J07, S08, S09."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import urls as U
from ..functions.text import normalise_name
from ..operators import crawl as C
from ..operators import enrich as N
from ..operators import registry as R
from ..operators.dataset import primary_code
from ..sources import fixtures as fx
from ..sources.tables import table
from .registry import query

BASE = "company_status = '1' AND registration_status = '1'"


def _rq(spark, sf):
    c = fx.v_companies(spark, sf)
    return R.RegistryQuery(c, R.default_catalog(c))


def _ids(df):
    return df.select("company_id", "org_nr")


@query("f01_exists", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND url IS NOT NULL AND trim(url) <> ''")
def f01(spark, sf):
    return _ids(_rq(spark, sf).exists(["url"]).fetch())


@query("f01_not_exists", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND NOT (url IS NOT NULL AND trim(url) <> '')")
def f01n(spark, sf):
    return _ids(_rq(spark, sf).exists(["url"], exists=False).fetch())


@query("f02_contains", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND contains(name, 'Aktie')")
def f02(spark, sf):
    return _ids(_rq(spark, sf).contains({"name": "Aktie"}).fetch())


@query("f03_equals", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND legal_form = '49'")
def f03(spark, sf):
    return _ids(_rq(spark, sf).equals({"legal_form": "49"}).fetch())


@query("f04_prefix", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND starts_with(org_nr, '00000001')")
def f04(spark, sf):
    return _ids(_rq(spark, sf).prefix({"org_nr": "00000001"}).fetch())


@query("f05_start_from", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND n_workplaces >= 15")
def f05(spark, sf):
    return _ids(_rq(spark, sf).start_from({"n_workplaces": "15"}).fetch())


@query("f06_up_to", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND n_workplaces <= 4")
def f06(spark, sf):
    return _ids(_rq(spark, sf).up_to({"n_workplaces": "4"}).fetch())


@query("f07_between", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND n_workplaces BETWEEN 5 AND 9")
def f07(spark, sf):
    return _ids(_rq(spark, sf).between({"n_workplaces": ("5", "9")}).fetch())


@query("f08_sni_level1", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND branch_codes[1] IN ('10111', '38110')")
def f08(spark, sf):
    return _ids(_rq(spark, sf).sni(["10111", "38110"], level=1).fetch())


@query("f08_sni_level2", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND branch_codes[2] IN ('38110')")
def f08b(spark, sf):
    return _ids(_rq(spark, sf).sni(["38110"], level=2).fetch())


@query("f08_sni_exclusion",
       f"""SELECT company_id, org_nr FROM v_companies WHERE {BASE}
AND branch_codes[1] IN (SELECT sni_code FROM v_sni WHERE sni_code NOT IN ('10111'))""")
def f08c(spark, sf):
    codes = fx.v_sni(spark).select("sni_code")
    return _ids(_rq(spark, sf).sni(["10111"], exclusion=True, all_codes=codes).fetch())


@query("f09_category", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE} AND municipality_code IN ('0001', '0005', '0017')")
def f09(spark, sf):
    return _ids(_rq(spark, sf).category(["0001", "0005", "0017"], "municipality_code").fetch())


@query("f09_category_table",
       f"""SELECT company_id, org_nr FROM v_companies WHERE {BASE}
AND legal_form IN (SELECT DISTINCT legal_form FROM v_companies WHERE legal_form <> '10')""")
def f09b(spark, sf):
    c = fx.v_companies(spark, sf)
    forms = c.select("legal_form").filter(F.col("legal_form") != "10").distinct()
    return _ids(_rq(spark, sf).category(forms, "legal_form").fetch())


@query("f10_base_filter", f"SELECT company_id, org_nr FROM v_companies WHERE {BASE}")
def f10(spark, sf):
    return _ids(_rq(spark, sf).fetch())


@query("f11_count",
       f"""SELECT CAST(count(*) AS BIGINT) AS n FROM v_companies WHERE {BASE}
AND branch_codes[1] IN ('10112') AND municipality_code IN ('0003', '0007') AND n_workplaces <= 10""")
def f11(spark, sf):
    q = _rq(spark, sf).sni(["10112"]).category(["0003", "0007"]).up_to({"n_workplaces": "10"})
    return q.count()


@query("f13_has_url_only", "SELECT company_id, org_nr FROM v_companies WHERE regexp_matches(url, '^\\S+$')")
def f13(spark, sf):
    return _ids(fx.v_companies(spark, sf).filter(N.has_url_filter("ONLY")))


@query("f14_has_url_no", "SELECT company_id, org_nr FROM v_companies WHERE url IS NULL OR regexp_matches(url, '^\\s*$')")
def f14(spark, sf):
    return _ids(fx.v_companies(spark, sf).filter(N.has_url_filter("no")))


@query("f15_has_url_both", "SELECT company_id, org_nr FROM v_companies")
def f15(spark, sf):
    return _ids(fx.v_companies(spark, sf).filter(N.has_url_filter("Both")))


@query("f16_companies_by_code",
       "SELECT company_id, org_nr FROM v_companies WHERE list_contains(branch_codes, '38110') AND regexp_matches(url, '^\\S+$')")
def f16(spark, sf):
    return _ids(N.companies_by_code(fx.v_companies(spark, sf), "38110", "only"))


@query("f17_some_url", "SELECT company_id, org_nr FROM v_companies WHERE regexp_matches(url, '\\S')")
def f17(spark, sf):
    return _ids(fx.v_companies(spark, sf).filter(N.has_some_url()))


_BL = ", ".join(f"'{d}'" for d in K.URL_BLACKLIST)


@query("f18_url_blacklist",
       f"""SELECT company_id, link FROM v_hits
WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest([{_BL}]) AS d) b WHERE contains(link, b.d))""")
def f18(spark, sf):
    return fx.v_hits(spark, sf).filter(N.not_blacklisted("link")).select("company_id", "link")


_PATH_SQL = "regexp_replace(regexp_extract(url, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"
_STOP = ", ".join("'" + t.replace("'", "''") + "'" for t in K.URL_STOP_TOKENS)


@query("f19_url_stop_tokens",
       f"""SELECT page_id, url, EXISTS (SELECT 1 FROM (SELECT unnest([{_STOP}]) AS t) s
       WHERE contains({_PATH_SQL}, s.t)) AS stopped FROM pages""")
def f19(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", C.stop_listed("url").alias("stopped"))


_STOP_CLEAN = ", ".join("'" + t.replace("'", "''") + "'" for t in K.URL_STOP_TOKENS_CLEAN)


@query("f19_url_stop_tokens_clean",
       f"""SELECT page_id, url, EXISTS (SELECT 1 FROM (SELECT unnest([{_STOP_CLEAN}]) AS t) s
       WHERE contains(concat({_PATH_SQL}, '?', regexp_extract(url, '\\?([^#]*)', 1)), s.t)) AS stopped FROM pages""")
def f19c(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", C.stop_listed("url", "clean").alias("stopped"))


@query("f20_prune_pages",
       f"""SELECT label, url FROM v_scraped WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest([{_STOP}]) AS t) s
       WHERE contains({_PATH_SQL}, s.t))""")
def f20(spark, sf):
    return C.prune_pages(fx.v_scraped(spark, sf)).select("label", "url")


@query("f22_has_name", "SELECT company_id, org_nr FROM v_companies WHERE name IS NOT NULL AND name <> ''")
def f22(spark, sf):
    return _ids(fx.v_companies(spark, sf).filter(N.has_name()))


@query("f25_point_lookup", "SELECT company_id, org_nr, name FROM v_companies WHERE org_nr = '0000000007'")
def f25(spark, sf):
    return N.lookup(fx.v_companies(spark, sf), "org_nr", "0000000007").select("company_id", "org_nr", "name")


@query("p01_normalise_register",
       """SELECT company_id, name, org_nr, municipality_code, municipality,
       concat(coalesce(branch_codes[1], ''), ',', coalesce(branch_codes[2], ''), ',', coalesce(branch_codes[3], '')) AS branch_codes,
       '' AS url FROM v_companies""")
def p01(spark, sf):
    n = R.normalise_register(fx.register_raw(spark, sf), keep=["company_id"])
    return n.select("company_id", "name", "org_nr", "municipality_code", "municipality",
                    F.array_join("branch_codes", ",", "").alias("branch_codes"), "url")


@query("p02_dimension_map",
       "SELECT DISTINCT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS code, n_name AS name FROM nation")
def p02(spark, sf):
    n = table(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("code"),
                                         F.col("n_name").alias("name"))
    m = R.as_map(n, "code", "name")
    return m.select(F.explode("map").alias("code", "name"))


@query("p03_search_name",
       "SELECT company_id, replace(replace(lower(name), 'aktiebolag', ''), 'handelsbolag', '') AS query FROM v_companies")
def p03(spark, sf):
    return N.search_names(fx.v_companies(spark, sf)).select("company_id", "query")


@query("p05_primary_code", "SELECT company_id, branch_codes[1] AS code FROM v_companies")
def p05(spark, sf):
    return fx.v_companies(spark, sf).select("company_id", primary_code().alias("code"))


@query("p06_start_urls", "SELECT org_nr AS label, url, 0 AS depth FROM v_companies WHERE regexp_matches(url, '^\\S+$')")
def p06(spark, sf):
    return C.start_urls(fx.v_companies(spark, sf))


@query("o01_code_exclusion",
       "SELECT DISTINCT branch_codes[1] AS sni_code FROM v_companies WHERE branch_codes[1] NOT IN ('10111', '38320')")
def o01(spark, sf):
    codes = fx.v_companies(spark, sf).select(primary_code().alias("sni_code")).distinct()
    return R.exclude_codes(codes, ["10111", "38320"])


@query("j07_code_municipality_forms",
       """SELECT company_id, org_nr FROM v_companies WHERE branch_codes[1] = '10112' AND municipality_code = '0005'
AND company_status = '1' AND registration_status = '1' AND legal_form IN (SELECT DISTINCT legal_form FROM v_companies WHERE legal_form IN ('49', '31'))""")
def j07(spark, sf):
    c = fx.v_companies(spark, sf)
    forms = c.select("legal_form").filter(F.col("legal_form").isin("49", "31")).distinct()
    return _ids(R.restrict_companies(c, "10112", "0005", forms))


def _category_tables(spark, sf):
    """The register's nested category tables, rebuilt from nation (seat
    municipalities at entry 4) and the companies' legal forms."""
    n = table(spark, sf, "nation").select(
        F.lit("SätesKommun").alias("cat"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("Varde"),
        F.col("n_name").alias("Text"))
    forms = fx.v_companies(spark, sf).select("legal_form").distinct().select(
        F.lit("Juridisk form").alias("cat"), F.col("legal_form").alias("Varde"),
        F.concat(F.lit("form "), F.col("legal_form")).alias("Text"))
    v = F.struct("Varde", "Text")
    lists = n.unionByName(forms).agg(
        F.collect_list(F.when(F.col("cat") == "SätesKommun", v)).alias("vl"),
        F.collect_list(F.when(F.col("cat") == "Juridisk form", v)).alias("fl"))
    e = lambda name, col: F.struct(F.lit(name).alias("Id_Kategori_JE"), col.alias("VardeLista"))
    empty = F.array().cast("array<struct<Varde:string,Text:string>>")
    return lists.select(F.array(
        e("Företagsstatus", empty), e("Registreringsstatus", empty), e("Juridisk form", F.col("fl")),
        e("Bransch", empty), e("SätesKommun", F.col("vl"))).alias("tables"))


@query("s08_flatten_municipalities",
       "SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS code, n_name AS name FROM nation")
def s08(spark, sf):
    return R.municipalities_from_categories(_category_tables(spark, sf))


@query("s09_flatten_legal_forms",
       "SELECT DISTINCT legal_form AS code, concat('form ', legal_form) AS description FROM v_companies WHERE legal_form IN ('49', '51')")
def s09(spark, sf):
    inc = fx.v_companies(spark, sf).select("legal_form").filter(F.col("legal_form").isin("49", "51")).distinct()
    return R.legal_forms_from_categories(_category_tables(spark, sf), inc)


@query("e16_normalise_name",
       "SELECT company_id, replace(replace(lower(name), 'aktiebolag', ''), 'handelsbolag', '') AS name_norm FROM v_companies")
def e16(spark, sf):
    return fx.v_companies(spark, sf).select("company_id", normalise_name("name").alias("name_norm"))


@query("e17_contains_any",
       f"""SELECT company_id, EXISTS (SELECT 1 FROM (SELECT unnest([{_BL}]) AS d) b WHERE contains(link, b.d)) AS hit FROM v_hits""")
def e17(spark, sf):
    from ..functions.text import contains_any
    return fx.v_hits(spark, sf).select("company_id", contains_any("link", K.URL_BLACKLIST).alias("hit"))


@query("e18_url_path", f"SELECT page_id, {_PATH_SQL} AS path FROM pages")
def e18(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.url_path("url").alias("path"))


_HOST_SQL = "lower(regexp_extract(url, '^(?:[^:/?#]+:)?//(?:[^@/?#]*@)?([^:/?#]*)', 1))"


@query("e19_host_domain_suffix",
       f"""SELECT page_id, host, regexp_extract(host, '([^.]+)\\.[^.]+$', 1) AS domain,
       regexp_extract(host, '([^.]+)$', 1) AS suffix FROM (SELECT page_id, {_HOST_SQL} AS host FROM pages)""")
def e19(spark, sf):
    p = U.with_registered_domain(table(spark, sf, "pages"), "url")
    return p.select("page_id", "host", "domain", "suffix")


def _variables(spark, sf):
    """Variables from the part brands, with register operators by the brand's number; the low numbers are owned."""
    brands = table(spark, sf, "part").select("p_brand", F.regexp_extract("p_brand", "(\\d+)", 1).cast("int").alias("n")).distinct()
    ops = F.when(F.col("n") % 2 == 0, F.array(F.lit("Innehaller"), F.lit("ArLikaMed"))).otherwise(F.array(F.lit("Mellan"), F.lit("Finns")))
    return (brands.select(F.col("p_brand").alias("variable"), ops.alias("operators")),
            brands.where("n <= 12").select(F.col("p_brand").alias("variable")))


_BRANDS = "SELECT DISTINCT p_brand AS variable, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS n FROM part"


@query("p04_variable_catalog",
       f"""SELECT variable, CASE WHEN n % 2 = 0 THEN 'contains,equals' ELSE 'between,exists' END AS methods, n <= 12 AS owned
FROM ({_BRANDS}) b""")
def p04(spark, sf):
    c = R.variable_catalog(*_variables(spark, sf))
    return c.select("variable", F.array_join("methods", ",").alias("methods"), "owned")


@query("f12_request_verdicts",
       f"""SELECT p_partkey, r.variable, method, CASE WHEN n IS NULL THEN 'unknown' WHEN n > 12 THEN 'not owned'
  WHEN (n % 2 = 0) <> (method = 'equals') THEN 'not allowed' ELSE 'ok' END AS verdict
FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'Nothing' ELSE p_brand END AS variable,
        CASE WHEN p_size % 2 = 0 THEN 'equals' ELSE 'exists' END AS method FROM part) r LEFT JOIN ({_BRANDS}) b USING (variable)""")
def f12(spark, sf):
    part = table(spark, sf, "part")
    requests = part.select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, "Nothing").otherwise(F.col("p_brand")).alias("variable"),
                           F.when(F.col("p_size") % 2 == 0, "equals").otherwise("exists").alias("method"))
    return R.judge_requests(requests, R.variable_catalog(*_variables(spark, sf)))


# Url forms built from each page: unlisted suffix, two-label suffix, listed only in a given table, IP, no scheme, one label.
_FORMS = ["concat('http://www.a', {i}, '.mx/x')", "concat('https://shop.b', {i}, '.co.uk?q=1')", "concat('http://u@c', {i}, '.com.mx:8080/')",
          "concat('http://10.0.0.', {i}, '/om')", "concat('www.d', {i}, '.se/om?u=http://x.de/')", "concat('HTTP://Host', {i}, '#top')",
          "concat('//e', {i}, '.example.tv')"]


def _forms(i: str) -> str:
    return " ".join(f"WHEN {k} THEN " + f.format(i=i) for k, f in enumerate(_FORMS))


@query("e19_url_forms",
       f"""SELECT page_id, host, regdom FROM (SELECT page_id, lower(h) AS host, CASE page_id % 7
  WHEN 0 THEN concat('a', i, '.mx') WHEN 1 THEN concat('b', i, '.co.uk') WHEN 2 THEN concat('c', i, '.com.mx') WHEN 3 THEN lower(h)
  WHEN 4 THEN concat('d', i, '.se') WHEN 5 THEN lower(h) ELSE 'example.tv' END AS regdom
FROM (SELECT page_id, i, regexp_extract(regexp_replace(regexp_replace(url, '^([A-Za-z]+:)?//', ''), '^u@', ''), '^[^:/?#]*') AS h
  FROM (SELECT page_id, i, CASE page_id % 7 {_forms('i')} END AS url
    FROM (SELECT page_id, CAST(page_id % 200 AS VARCHAR) AS i FROM pages) a) b) c) d""")
def e19_forms(spark, sf):
    """Registered domains by a suffix table and the default rule (last label)."""
    p = table(spark, sf, "pages").select("page_id", (F.col("page_id") % 200).cast("string").alias("i"))
    p = p.select("page_id", F.expr(f"CASE page_id % 7 {_forms('i')} END").alias("url"))
    listed = spark.createDataFrame([("co.uk",), ("com.mx",), ("se",), ("mx",)], "suffix string")
    return U.with_registered_domain(p, "url", suffixes=listed).select("page_id", "host", U.registered_domain().alias("regdom"))


#: rules in the published forms: plain, wildcard, exception, in Unicode and in ASCII form
RULE_LINES = ["// comment", "", "com", "uk", "co.uk  // text after the rule", "*.ck", "!www.ck", "cn", "公司.cn", "jp", "*.kawasaki.jp",
              "!city.kawasaki.jp", "xn--p1ai", "blogspot.com"]
TAILS = [".example.com", ".x.co.uk", ".a.b.ck", ".www.ck", ".city.kawasaki.jp", ".a.kawasaki.jp", ".b.c.kawasaki.jp", ".食狮.公司.cn",
         ".xn--85x722f.xn--55qx5d.cn", ".nowhere", ".рф", ".blogspot.com", "b.ck"]
_TAIL_CASE = "CASE page_id % 13 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TAILS)) + " END"


@query("e19_public_suffix_rules",
       f"""WITH r AS (SELECT * FROM (VALUES ('com'), ('uk'), ('co.uk'), ('*.ck'), ('!www.ck'), ('cn'), ('xn--55qx5d.cn'), ('jp'),
  ('*.kawasaki.jp'), ('!city.kawasaki.jp'), ('xn--p1ai'), ('blogspot.com')) AS t(rule)),
h AS (SELECT page_id, concat('p', CAST(page_id % 100 AS VARCHAR), {_TAIL_CASE}) AS host FROM pages),
l AS (SELECT page_id, host, string_split(host, '.') AS own,
             string_split(replace(replace(host, '公司', 'xn--55qx5d'), 'рф', 'xn--p1ai'), '.') AS norm FROM h),
e AS (SELECT page_id, k, array_to_string(norm[len(norm) - k + 1:], '.') AS tail, array_to_string(norm[len(norm) - k + 2:], '.') AS shorter
      FROM (SELECT page_id, norm, unnest(range(1, len(norm) + 1)) AS k FROM l) x),
m AS (SELECT page_id, max(CASE WHEN rule LIKE '!%' THEN 1000 + k - 1 ELSE k END) AS k
      FROM e JOIN r ON rule = tail OR (k > 1 AND rule = '*.' || shorter) OR rule = '!' || tail GROUP BY page_id)
SELECT page_id, host, coalesce(own[len(own) - coalesce(k % 1000, 1)], '') AS domain,
       array_to_string(own[len(own) - coalesce(k % 1000, 1) + 1:], '.') AS suffix FROM l LEFT JOIN m USING (page_id)""")
def e19_rules(spark, sf):
    """E19 by published suffix rules over hosts of every form, one for each page."""
    p = table(spark, sf, "pages").select("page_id")
    host = F.concat(F.lit("http://p"), (F.col("page_id") % 100).cast("string"), F.expr(_TAIL_CASE), F.lit("/x"))
    rules = U.suffix_rules(spark.createDataFrame([(r,) for r in RULE_LINES], "line string"))
    return U.with_public_suffix(p.withColumn("url", host), rules).select("page_id", "host", "domain", "suffix")
