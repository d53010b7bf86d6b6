"""Corpus building: H15, J01-J03, A01-A04, W01, W02, P05, O03, F23, M01, E15.

Extracted text is kept in long form, one row per page
``(company_id, run_ts, seq, url, method, data)``. The reference nests all
pages of a company run into one document; a hot company would then be one
unbounded row, so nesting happens only in ``assemble_documents``, after the
1,000,000-character cut has bounded what each document can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import join_page_texts, one_hot_labels, truncate
from .enrich import has_some_url
from .html import page_text, parse_pages
from ..session import staged
from .ordered import BROADCAST_MAX_BYTES, broadcast_if_small, fits_broadcast, prefix_rank


def primary_code(branch_col: str = "branch_codes") -> Column:
    """First branch code (NULL when there is none)."""
    return F.get(F.col(branch_col), 0)


def first_company_per_org_nr(companies: DataFrame) -> DataFrame:
    """One company per organisation number (the first by ``company_id``)."""
    return (companies.groupBy("org_nr")
            .agg(F.min_by(F.struct("company_id", "url", "branch_codes"), "company_id").alias("c"))
            .select("org_nr", "c.company_id", F.col("c.url").alias("company_url"), "c.branch_codes"))


def extract_pages(pages: DataFrame, filter_: bool = True, p_only: bool = False,
                  extract_meta: bool = True, extract_body: bool = True,
                  year_mode: str = "reference", html_col: str = "raw_html",
                  keep: list[str] | None = None) -> DataFrame:
    """H01+H09+E08: parse each page and compose its text (cut at 1M chars).

    Narrow (no shuffle); unparseable pages are dropped.
    """
    keep = keep or [c for c in pages.columns if c != html_col]
    parts = (("paras",) if p_only else ("nodes",) if extract_body else ()) + (("metas",) if extract_meta else ())
    parsed = parse_pages(pages, html_col=html_col, url_col="url", keep=keep, parts=parts).filter("ok")
    text = truncate(page_text(filter_=filter_, p_only=p_only, extract_meta=extract_meta,
                              extract_body=extract_body, year_mode=year_mode))
    return parsed.select(*keep, text.alias("data"))


def attach_companies(texts: DataFrame, companies: DataFrame) -> DataFrame:
    """Page texts -> company by ``label = org_nr`` (unmatched dropped)."""
    comp = first_company_per_org_nr(companies)
    return texts.join(comp, texts["label"] == comp["org_nr"], "inner").drop("org_nr")


def unmatched_pages(pages: DataFrame, companies: DataFrame, html_col: str = "raw_html",
                    max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Pages whose label is no company's organisation number (the
    error report: page columns without the HTML, which is not shuffled)."""
    keys = companies.select(F.col("org_nr").alias("label")).distinct()
    if fits_broadcast(companies, max_broadcast_bytes):
        keys = F.broadcast(keys)
    return pages.drop(html_col).join(keys, "label", "left_anti")


def extraction_job(pages: DataFrame, companies: DataFrame, run_ts: str,
                   extract_meta: bool = True, extract_body: bool = True, p_only: bool = False,
                   seq_col: str = "page_id", max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
                   mode: str = "reference") -> DataFrame:
    """Pages -> extracted rows in long form.

    Raw HTML is never shuffled. When the company dimension (one row per
    organisation number) provably fits a broadcast, pages of unknown labels
    are dropped before the parse and the company join is a broadcast hash
    join, so the whole job is narrow. Otherwise every page is parsed where
    it lies and only the extracted text is shuffled into the join. The row
    keeps the company's registered url (``reference``) or the url of the
    page the text came from (``clean``).
    """
    comp = first_company_per_org_nr(companies)
    # the raw row count bounds the de-duplicated one, and needs no shuffle
    small = fits_broadcast(companies, max_broadcast_bytes)
    if small:
        comp = F.broadcast(comp)
        pages = pages.join(comp.select(F.col("org_nr").alias("label")), "label", "left_semi")
    texts = extract_pages(pages, filter_=True, p_only=p_only, extract_meta=extract_meta,
                          extract_body=extract_body, keep=["label", "url", seq_col])
    rows = texts.join(comp, texts["label"] == comp["org_nr"], "inner").drop("org_nr")
    method = F.array(F.lit(extract_meta), F.lit(extract_body), F.lit(p_only))
    url = F.col("company_url") if mode == "reference" else F.col("url")
    return rows.select("company_id", F.lit(run_ts).cast("timestamp").alias("run_ts"),
                       F.col(seq_col).alias("seq"), url.alias("url"),
                       method.alias("method"), "data", "branch_codes")


def run_summary(extracted: DataFrame) -> DataFrame:
    """A02 (bounded form): per company run, page count and text length."""
    return extracted.groupBy("company_id", "run_ts").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum(F.length("data")).alias("total_chars"))


def extraction_stats(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages per primary code, and the global totals (average length
    per code = total length / distinct codes; NULL when there are none)."""
    x = extracted.withColumn("code", primary_code())
    per = x.groupBy("code").agg(F.count(F.lit(1)).alias("n_urls"))
    tot = x.agg(F.count(F.lit(1)).alias("n_urls"),
                F.countDistinct("code").alias("n_labels"),
                F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("total_length"))
    tot = tot.withColumn("avg_length_per_label",
                         F.when(F.col("n_labels") > 0, F.col("total_length") / F.col("n_labels")))
    return per, tot


def latest_runs(extracted: DataFrame) -> DataFrame:
    """Pages of each company's latest run (a decomposable max plus a
    semi-join, so a company with very many pages is not one task)."""
    last = extracted.groupBy("company_id").agg(F.max("run_ts").alias("run_ts"))
    return extracted.join(last, ["company_id", "run_ts"], "left_semi")


def companies_by_primary_code(companies: DataFrame) -> DataFrame:
    """Companies with some url, per primary code (NULL for none)."""
    return (companies.filter(has_some_url("url"))
            .groupBy(primary_code().alias("code"))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.min("company_id").alias("min_company_id"),
                 F.max("company_id").alias("max_company_id")))


def split_assignment(companies: DataFrame, extracted: DataFrame,
                     pct=(K.SPLIT_PCT[0], K.SPLIT_PCT[1], K.SPLIT_PCT[2]),
                     mode: str = "reference") -> DataFrame:
    """W02 + J03: exact stratified split per primary code.

    ``n`` = companies with some url in the code, ``d = n*dev div 100``,
    ``t = n*test div 100``; companies with url and extracted data are ranked
    by ``company_id`` (rank ``r``): dev if r = 1 or r <= d, test if
    r <= d + t, else train. Returns ``(company_id, code, branch_codes, split)``.

    ``clean``: ``n`` counts only the companies that get a row (with url and
    data), and the first company goes to dev only when the dev quota is
    not 0.
    """
    train, dev, test = pct
    if train + dev + test != 100:
        raise ValueError("The sum of the data split percentages must be 100.")
    withurl = companies.filter(has_some_url("url")).select(
        "company_id", "branch_codes", primary_code().alias("code"))
    n = withurl.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    has_data = extracted.select("company_id").distinct()
    members = withurl.join(has_data, "company_id", "left_semi")
    if mode == "clean":
        n = members.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    ranked = prefix_rank(members, ["code"], "company_id", rank_col="r",
                         bounds_from=withurl.select("company_id"))
    quotas = broadcast_if_small(
        n.select("code", (F.col("n") * dev / 100).cast("long").alias("d"),
                 (F.col("n") * test / 100).cast("long").alias("t")))
    j = ranked.join(quotas, ranked["code"].eqNullSafe(quotas["code"]), "inner").drop(quotas["code"])
    first_dev = (F.col("r") == 1) if mode == "reference" else F.lit(False)
    split = (F.when(first_dev | (F.col("r") <= F.col("d")), "dev")
             .when(F.col("r") <= F.col("d") + F.col("t"), "test").otherwise("train"))
    return j.select("company_id", "code", "branch_codes", split.alias("split"))


def build_dataset(companies: DataFrame, extracted: DataFrame, pct=K.SPLIT_PCT,
                  mode: str = "reference") -> DataFrame:
    """W02 + S06 input: latest-run pages of each split company with its split.

    Latest run and split meet on a table of companies; the page texts are
    joined to it once.
    """
    last = extracted.groupBy("company_id").agg(F.max("run_ts").alias("run_ts"))
    keys = split_assignment(companies, extracted, pct, mode).select("company_id", "branch_codes", "split")
    pages = extracted.drop("branch_codes") if "branch_codes" in extracted.columns else extracted
    return pages.join(last.join(keys, "company_id"), ["company_id", "run_ts"], "inner") \
        .select(*pages.columns, "branch_codes", "split")


def assemble_documents(pages: DataFrame, keys: list[str], seq_col: str = "seq",
                       text_col: str = "data", max_chars: int = K.MAX_TEXT_CHARS,
                       bounds_from: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """E09 + E08: one text per key = each page text preceded by one space,
    in ``seq`` order, cut at ``max_chars``. ``carry`` columns depend on the
    key and are kept.

    Lengths are summed per key without the texts, and the keys beyond the cut
    are staged (they are few, so the planner broadcasts them by their size).
    All others hold at most ``max_chars`` and are grouped directly: the texts
    are shuffled once. For the keys beyond it the skew-safe running length
    (``prefix_rank``) first drops the pages that start beyond the cut, so a
    group never holds more than ``max_chars`` plus one page.
    """
    plen = F.length(F.col(text_col)) + 1
    x = pages.select(*keys, *carry, seq_col, text_col)

    def nest(df: DataFrame) -> DataFrame:
        docs = df.groupBy(*keys, *carry).agg(
            F.array_sort(F.collect_list(F.struct(F.col(seq_col).alias("s"),
                                                 F.col(text_col).alias("data")))).alias("_p"))
        return docs.select(*keys, *carry, truncate(join_page_texts("_p"), max_chars).alias("text"))

    over = staged(x.groupBy(*keys).agg(F.sum(plen).alias("_tot")).filter(F.col("_tot") > max_chars).select(*keys), "long_keys")
    if over.isEmpty():
        return nest(x)
    ranked = prefix_rank(x.join(over, keys, "left_semi"), keys, seq_col, value=plen, rank_col="_r", before_col="_before",
                         bounds_from=bounds_from)
    cut = nest(ranked.filter(F.col("_before") < max_chars).drop("_r", "_before"))
    return nest(x.join(over, keys, "left_anti")).unionByName(cut)


def build_corpus(dataset: DataFrame, min_chars: int = K.MIN_TEXT_CHARS,
                 max_chars: int = K.MAX_TEXT_CHARS, bounds_from: DataFrame | None = None) -> DataFrame:
    """One labelled document per company and split; documents shorter
    than ``min_chars`` are dropped (F23); ``cats`` is the one-hot map (E15).
    A company lies in one split, so split and label are carried along."""
    labelled = dataset.withColumn("sni_code", primary_code())
    docs = assemble_documents(labelled, ["company_id"], max_chars=max_chars, bounds_from=bounds_from,
                              carry=("split", "sni_code"))
    return docs.filter(F.length("text") >= min_chars).withColumn("n_chars", F.length("text"))


def with_cats(corpus: DataFrame, code_list: list[str]) -> DataFrame:
    """``cats`` = {code: 0 for every known code} with the true code = 1
    (an unknown true code is added as an extra key)."""
    codes = F.array(*[F.lit(c) for c in code_list])
    return corpus.withColumn("cats", one_hot_labels(codes, F.col("sni_code")))


def corpus_stats(corpus: DataFrame) -> DataFrame:
    """Documents and total length per split, per label and overall in
    one pass (grouping sets). ``average_length_per_label`` of the overall row
    is total length / distinct labels."""
    g = corpus.groupingSets([["split"], ["sni_code"], []], "split", "sni_code").agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_chars").cast("long").alias("total_length"),
        F.countDistinct("sni_code").alias("n_labels"))
    level = F.when(F.col("gid") == 1, "split").when(F.col("gid") == 2, "label").otherwise("total")
    return g.select(level.alias("level"), "split", "sni_code", "n_docs", "total_length", "n_labels",
                    F.when(F.col("n_labels") > 0, F.col("total_length") / F.col("n_labels"))
                    .alias("average_length_per_label"))


def filter_min_length(df: DataFrame, text_col: str = "text", min_chars: int = K.MIN_TEXT_CHARS) -> DataFrame:
    """F23."""
    return df.filter(F.length(text_col) >= min_chars)


def union_splits(*splits: DataFrame) -> DataFrame:
    """O03."""
    out = splits[0]
    for s in splits[1:]:
        out = out.unionByName(s)
    return out


def split_by_rank(df: DataFrame, key: str, order: str, pct=K.SPLIT_PCT) -> DataFrame:
    """W02 formula with ``n`` = the group's own size (every member counted)."""
    train, dev, test = pct
    if train + dev + test != 100:
        raise ValueError("The sum of the data split percentages must be 100.")
    ranked = prefix_rank(df, [key], order, rank_col="_r")
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    j = ranked.join(broadcast_if_small(n), key)
    d = (F.col("_n") * dev / 100).cast("long")
    t = (F.col("_n") * test / 100).cast("long")
    split = (F.when((F.col("_r") == 1) | (F.col("_r") <= d), "dev")
             .when(F.col("_r") <= d + t, "test").otherwise("train"))
    return j.withColumn("split", split).drop("_r", "_n")
