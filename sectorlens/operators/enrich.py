"""URL enrichment: P03, F13-F18, F22, F25, J05, J08-J10, W03."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import contains_any, normalise_name
from ..functions.urls import registered_domain, with_registered_domain
from ..session import staged
from .ordered import broadcast_if_small, top_k_per_key

# Java regex: (?U) gives Unicode \s / \S.
_ONLY = r"(?U)^\S+$"
_NONE = r"(?U)^\s*$"
_SOME = r"(?U)\S"


def has_url_filter(mode: str = "BOTH", url: str = "url") -> Column:
    """ONLY = url entirely non-white-space; NO = missing or blank;
    anything else (BOTH, case-insensitive) = no condition."""
    m = mode.upper()
    if m == "ONLY":
        return F.coalesce(F.col(url).rlike(_ONLY), F.lit(False))
    if m == "NO":
        return F.col(url).isNull() | F.col(url).rlike(_NONE)
    return F.lit(True)


def companies_by_code(companies: DataFrame, code: str, has_url: str = "BOTH") -> DataFrame:
    """F16: companies carrying ``code`` anywhere in ``branch_codes``."""
    return companies.filter(F.array_contains("branch_codes", code) & has_url_filter(has_url))


def has_some_url(url: str = "url") -> Column:
    """url with at least one non-white-space character."""
    return F.coalesce(F.col(url).rlike(_SOME), F.lit(False))


def not_blacklisted(url: str = "url", blacklist=K.URL_BLACKLIST) -> Column:
    """no blacklisted domain is a substring of the url."""
    return ~contains_any(url, blacklist)


def has_name(name: str = "name") -> Column:
    """F22."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def lookup(df: DataFrame, col: str, key) -> DataFrame:
    """point lookup (first match by ``company_id`` when several)."""
    hits = df.filter(F.col(col) == F.lit(key))
    first = hits.agg(F.min_by(F.struct(*df.columns), F.col("company_id")).alias("_m"))
    return first.filter(F.col("_m").isNotNull()).select("_m.*")


def search_names(companies: DataFrame) -> DataFrame:
    """The query string sent to the search engine for a company."""
    return companies.withColumn("query", normalise_name("name"))


def first_hits(hits: DataFrame) -> DataFrame:
    """The first result link per query (rank 1)."""
    return (hits.filter(F.col("rank") == 1).groupBy("name")
            .agg(F.min("link").alias("link")))


def attach_first_hit(companies: DataFrame, hits: DataFrame) -> DataFrame:
    """Normalised name -> link of the first hit, '' when there is none."""
    q = search_names(companies)
    fh = first_hits(hits).withColumnRenamed("name", "query")
    return q.join(fh, "query", "left").withColumn("link", F.coalesce("link", F.lit("")))


def bulk_first_hits(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """First hit of each query, in query order (``pos``)."""
    fh = first_hits(hits).withColumnRenamed("name", "query")
    return (queries.join(fh, "query", "left")
            .select("pos", "query", F.coalesce("link", F.lit("")).alias("link")).orderBy("pos"))


def serial_code_quota(companies: DataFrame, codes: DataFrame, limit: int = K.LOOKUPS_PER_CODE,
                      has_url: str = "NO", salts: int = 64, staying: DataFrame | None = None) -> DataFrame:
    """Which companies get looked up, and for which code.

    Codes are visited in ascending order; each takes up to ``limit`` of its
    eligible companies (no url, non-empty name) by ``company_id``; a company
    taken by an earlier code is not eligible later. That is the
    company-proposing deferred acceptance with quotas, computed in rounds by
    deltas: only rejected companies propose again, to their next code that is
    not full of smaller ids. A code's bound (the largest id it holds once it
    is full) only falls, so skipped codes would have rejected them as well.
    Each round stores the places held (at most codes x limit) and those who
    propose next. ``staying`` names companies (company_id) that remain
    eligible for later codes after they were taken: each of their codes is a
    proposal of its own. Companies without an id take no place.
    Returns ``(company_id, code)``.
    """
    code_list = codes.select(F.col(codes.columns[0]).alias("code")).distinct()
    elig = companies.filter(has_url_filter(has_url) & has_name() & F.col("company_id").isNotNull()).select("company_id", "branch_codes")
    pairs = (elig.select("company_id", F.explode(F.array_distinct("branch_codes")).alias("code"))
             .join(code_list, "code", "left_semi"))
    # each company's candidate codes in ascending order
    ranked = pairs.groupBy("company_id").agg(F.array_sort(F.collect_set("code")).alias("later")).withColumn("seat", F.lit(""))
    if staying is not None:
        ids = broadcast_if_small(staying.select("company_id").distinct())
        ranked = ranked.join(ids, "company_id", "left_anti").unionByName(
            pairs.distinct().join(ids, "company_id", "left_semi")
            .select("company_id", F.array("code").alias("later"), F.col("code").alias("seat")))
    shape = ["company_id", "seat", "code", "later"]    # ``later``: the codes after ``code``
    after = F.slice("later", 2, F.size("later"))
    asking = staged(ranked.select("company_id", "seat", F.get("later", F.lit(0)).alias("code"), after.alias("later")), "quota-asking")
    held = None
    while True:
        now = asking if held is None else asking.unionByName(held)
        held = staged(top_k_per_key(now, ["code"], ["company_id"], limit, salt_on="company_id", salts=salts).select(*shape),
                      "quota-held")
        bounds = (held.groupBy("code").agg(F.max("company_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") >= limit).select(F.col("code").alias("_full"), "_last"))
        places = broadcast_if_small(held.select("company_id", "seat", "code"))
        out = now.join(places, ["company_id", "seat", "code"], "left_anti").where(F.size("later") > 0)
        tried = (out.select("company_id", "seat", "later", F.posexplode("later").alias("_at", "_next"))
                 .join(broadcast_if_small(bounds), F.col("_next") == F.col("_full"), "left")
                 .where(F.col("_last").isNull() | (F.col("company_id") < F.col("_last"))))
        first = F.min(F.struct("_at", "_next", F.slice("later", F.col("_at") + 2, F.size("later")).alias("_rest")))
        asking = staged(tried.groupBy("company_id", "seat").agg(first.alias("_k"))
                        .select("company_id", "seat", F.col("_k._next").alias("code"), F.col("_k._rest").alias("later")), "quota-asking")
        if asking.isEmpty():
            return held.select("company_id", "code")


def successful_lookups(companies: DataFrame, hits: DataFrame) -> DataFrame:
    """Companies whose first hit is a usable url: a lookup keeps them."""
    return attach_first_hit(companies, hits).filter((F.col("link") != "") & not_blacklisted("link")).select("company_id")


def apply_lookup_results(companies: DataFrame, processed: DataFrame, hits: DataFrame) -> DataFrame:
    """Processed companies get the first-hit url when it is non-empty and
    not blacklisted; otherwise they are removed. Others are unchanged."""
    # processed companies number at most codes x limit: broadcast (checked)
    done = broadcast_if_small(processed.select("company_id").distinct())
    found = (attach_first_hit(companies.join(done, "company_id", "left_semi"), hits)
             .select("company_id", "link"))
    j = companies.join(broadcast_if_small(found), "company_id", "left")
    ok = (F.col("link") != "") & not_blacklisted("link")
    return (j.filter(F.col("link").isNull() | ok)
            .withColumn("url", F.when(F.col("link").isNotNull(), F.col("link")).otherwise(F.col("url")))
            .drop("link"))


def company_by_url(urls: DataFrame, companies: DataFrame, url_col: str = "url") -> DataFrame:
    """J05 (scalable form): find the company of each url.

    First an equi-join on the full host, then, for the misses, on the
    registered domain; the first company by ``company_id`` wins.
    ``company_by_url_reference`` finds hosts anywhere in the stored url.
    """
    u = with_registered_domain(urls, url_col, prefix="q_").withColumn("q_regdom", registered_domain("q_"))
    c = (with_registered_domain(companies.select("company_id", F.col("url").alias("c_url"))
                                .filter(has_some_url("c_url")), "c_url", prefix="c_")
         .withColumn("c_regdom", registered_domain("c_")))
    by_host = c.groupBy(F.col("c_host").alias("q_host")).agg(F.min("company_id").alias("company_id"))
    by_dom = c.groupBy(F.col("c_regdom").alias("q_regdom")).agg(F.min("company_id").alias("company_id"))
    first = u.join(by_host.filter("q_host != ''"), "q_host", "left")
    # one more join for the misses; hits get a key of their own that matches nothing
    # (spread, so they do not meet in one task)
    missing = F.col("company_id").isNull() & (F.col("q_regdom") != "")
    key = F.when(missing, F.col("q_regdom")).otherwise(F.concat(F.lit("/"), F.xxhash64("q_host", url_col).cast("string")))
    by_dom = by_dom.filter("q_regdom != ''").select(F.col("q_regdom").alias("_dom"), F.col("company_id").alias("_by_dom"))
    return (first.withColumn("_key", key).join(by_dom, F.col("_key") == F.col("_dom"), "left")
            .withColumn("company_id", F.coalesce("company_id", "_by_dom")).drop("_key", "_dom", "_by_dom"))


GRAM_SIZES = (4, 3, 2, 1)


def _grams(text: Column, n: Column) -> Column:
    """Every run of ``n`` characters of ``text``."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i, n))


def first_by_pattern(patterns: DataFrame, stored: DataFrame) -> DataFrame:
    """(pattern, company_id): the first company whose url holds the pattern, ``.`` standing for any character.

    ``patterns`` has distinct rows of one column ``pattern``, ``stored`` distinct
    rows (s_url, company_id). The urls are posted by character n-grams, only
    those that some pattern holds; each pattern looks at the postings of its
    rarest literal n-gram (of the longest size it has) and verifies the whole
    pattern there. An empty pattern is in every url.
    """
    pieces = F.split("pattern", r"\.")
    longest = F.array_max(F.transform(pieces, lambda p: F.length(p)))
    size = F.least(F.lit(GRAM_SIZES[0]), longest)
    held = staged(patterns.where("pattern != ''").select("pattern", size.alias("n")).select(
        "pattern", "n", F.explode(F.array_distinct(F.flatten(F.transform(pieces, lambda p: _grams(p, F.col("n")))))).alias("gram")), "pattern-grams")
    needed = held.select("gram").distinct()
    sizes = F.array(*[F.lit(r[0]) for r in held.select("n").distinct().collect()] or [F.lit(1)])
    posted = stored.select("s_url", "company_id", F.explode(F.array_distinct(F.flatten(
        F.transform(sizes, lambda n: _grams(F.col("s_url"), n))))).alias("gram"))
    postings = staged(posted.join(broadcast_if_small(needed), "gram", "left_semi"), "url-grams")
    times = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
    rarest = (held.join(times, "gram", "left").groupBy("pattern")
              .agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram")).alias("k"))
              .where("k.times > 0").select("pattern", F.col("k.gram").alias("gram")))
    whole = F.concat(F.lit("\\Q"), F.replace(F.col("pattern"), F.lit("."), F.lit("\\E.\\Q")), F.lit("\\E"))
    found = (rarest.join(postings, "gram").where(F.regexp_like("s_url", whole))
             .groupBy("pattern").agg(F.min("company_id").alias("company_id")))
    every = stored.agg(F.min("company_id").alias("company_id")).where("company_id is not null")
    return found.unionByName(every.select(F.lit("").alias("pattern"), "company_id"))


def company_by_url_reference(urls: DataFrame, companies: DataFrame, url_col: str = "url") -> DataFrame:
    """J05 as observed: the company whose url holds the looked-up host anywhere.

    The host (empty where it has no suffix, as for an IP address) is searched
    unescaped, so ``.`` matches any character and an empty host every stored
    url; then, for the misses, the registered domain. The first company by
    ``company_id`` wins; a null stored url matches nothing. Other characters
    are literal, and the search keeps upper and lower case apart.
    """
    taken = {"q_host", "q_domain", "q_suffix", "pattern", "company_id", "_base", "_found"} & set(urls.columns) - {url_col}
    if taken:
        raise ValueError(f"columns are taken: {sorted(taken)}")
    stored = staged(companies.where(F.col("url").isNotNull()).groupBy(F.col("url").alias("s_url"))
                    .agg(F.min("company_id").alias("company_id")), "urls")
    q = with_registered_domain(urls, url_col, prefix="q_")
    full = F.when(F.col("q_suffix") == "", "").otherwise(F.col("q_host"))
    q = staged(q.withColumn("pattern", full).withColumn("_base", F.concat_ws(".", "q_domain", "q_suffix")), "lookups")
    first = first_by_pattern(q.select("pattern").distinct(), stored)
    hit = staged(q.select("pattern", "_base").distinct().join(first, "pattern", "left"), "lookups-host")
    second = first_by_pattern(hit.where("company_id is null").select(F.col("_base").alias("pattern")).distinct(), stored)
    named = (hit.where("company_id is null").drop("company_id").join(second.withColumnRenamed("pattern", "_base"), "_base", "left")
             .unionByName(hit.where("company_id is not null"))
             .select("pattern", F.col("_base").alias("_b"), "company_id"))
    return (q.join(named, (q["pattern"] == named["pattern"]) & (q["_base"] == named["_b"]), "left")
            .select(*[q[f"`{c}`"] for c in urls.columns], "company_id"))
