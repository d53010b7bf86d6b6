"""Crawl frontier: P06, F19, F20, H13, H14, J04, J11, O04 (S02/S10 in sources)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import contains_any
from ..functions.urls import registered_domain, url_path, with_registered_domain
from .enrich import has_url_filter


def start_urls(companies: DataFrame) -> DataFrame:
    """Frontier seed ``(label = org_nr, url, depth = 0)`` for companies
    whose url is entirely non-white-space."""
    return companies.filter(has_url_filter("ONLY")).select(
        F.col("org_nr").alias("label"), "url", F.lit(0).alias("depth"))


def stop_listed(url: str | Column = "url", mode: str = "reference") -> Column:
    """true when any stop token is a substring of the url path
    (case-sensitive). ``reference``: the path only, fused token kept;
    ``clean``: path and query string (so ``?lang=en`` matches), with the
    fused token split in two."""
    if mode == "reference":
        return contains_any(url_path(url), K.URL_STOP_TOKENS)
    u = F.col(url) if isinstance(url, str) else url
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return contains_any(F.concat(url_path(u), F.lit("?"), query), K.URL_STOP_TOKENS_CLEAN)


def prune_pages(pages: DataFrame, mode: str = "reference") -> DataFrame:
    """stored pages whose url path hits a stop token are removed."""
    return pages.filter(~stop_listed("url", mode))


def dedupe_frontier(frontier: DataFrame) -> DataFrame:
    """First entry per url: smallest depth, then smallest label (a
    decomposable min, so a url repeated a billion times is still cheap)."""
    return (frontier.groupBy("url").agg(F.min(F.struct("depth", "label")).alias("m"))
            .select(F.col("m.label").alias("label"), "url", F.col("m.depth").alias("depth")))


def unscraped(frontier: DataFrame, scraped: DataFrame) -> DataFrame:
    """Frontier minus already stored urls."""
    return dedupe_frontier(frontier).join(scraped.select("url").distinct(), "url", "left_anti")


def scraped_set(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored urls union newly saved urls."""
    return stored.select("url").union(new.select("url")).distinct()


def discovered_links(pages: DataFrame, scraped: DataFrame) -> DataFrame:
    """Follow links of depth-0 pages: same registered domain as the
    page, path contains a follow fragment, not the page itself, not stored.
    ``pages``: (label, url, depth, links)."""
    src = with_registered_domain(pages.filter(F.col("depth") < 1), "url", prefix="p_") \
        .withColumn("p_regdom", registered_domain("p_"))
    ex = src.select("label", F.col("url").alias("page_url"), "depth", "p_regdom",
                    F.explode("links").alias("link"))
    ex = with_registered_domain(ex, "link", prefix="l_").withColumn("l_regdom", registered_domain("l_"))
    follow = contains_any(url_path("link"), K.FOLLOW_QUERIES)
    cand = ex.filter(follow & (F.col("l_regdom") == F.col("p_regdom")) & (F.col("link") != F.col("page_url")))
    out = cand.select("label", F.col("link").alias("url"), (F.col("depth") + 1).alias("depth")) \
        .dropDuplicates(["label", "url"])
    return out.join(scraped.select("url").distinct(), "url", "left_anti").select("label", "url", "depth")


def next_frontier(frontier: DataFrame, pages: DataFrame, scraped: DataFrame,
                  filter_: bool = False, mode: str = "reference") -> DataFrame:
    """The frontier grown by one link level, stop-listed urls dropped
    (when ``filter_``), de-duplicated and minus stored urls."""
    grown = frontier.select("label", "url", "depth").unionByName(discovered_links(pages, scraped))
    if filter_:
        grown = grown.filter(~stop_listed("url", mode))
    return unscraped(grown, scraped)
