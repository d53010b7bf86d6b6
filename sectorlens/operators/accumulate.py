"""A02 across runs and A01's id lists, both without unbounded groups.

Page texts of a (company, run) accumulate over batches: each batch appends
its pages behind those already there. Pages stay one row each, in folders by
(bucket of the company, batch); beside them lies what every batch added to
every document (pages, characters, last place). So a batch reads the small state of the
buckets it touches and never an old text, writes only its own folders, and can
be repeated: it replaces what it wrote before. A page that begins beyond the
document's cut is counted in the state and not kept.

Defined cases: a null text counts as empty; null keys are a document of their
own; batches are named by strings and append in the order they are run, a
repeated batch with what it held before; pages of one batch lie in ``seq``
order, those of equal ``seq`` together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import truncate
from ..session import staged
from ..sources.tables import path_exists
from .enrich import has_some_url
from .ordered import broadcast_if_small, prefix_rank

KEYS = ["company_id", "run_ts"]
ID_BLOCK = 1024


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("company_id", F.lit("bucket")), F.lit(buckets)).cast("int")


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a[KEYS[0]].eqNullSafe(b[KEYS[0]]) & a[KEYS[1]].eqNullSafe(b[KEYS[1]])


def _state(spark: SparkSession, path: str) -> DataFrame:
    held = spark.read.parquet(f"{path}/state")
    return held.withColumn("batch", F.col("batch").cast("string"))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(path)


def accumulate_pages(pages: DataFrame, path: str, batch: str, buckets: int = 64, max_chars: int = K.MAX_TEXT_CHARS) -> None:
    """Append a batch of (company_id, run_ts, seq, url, method, data) to the documents at ``path``."""
    spark = pages.sparkSession
    new = (pages.select(*KEYS, "seq", "url", "method", F.coalesce("data", F.lit("")).alias("data"))
           .withColumn("bucket", _bucket(buckets)).withColumn("batch", F.lit(batch)))
    # places are found on sizes alone; the texts meet them once
    sizes = staged(new.groupBy(*KEYS, "seq", "bucket", "batch").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("data") + 1).cast("long").alias("n_chars")), "batch-sizes")
    added = sizes.groupBy(*KEYS, "bucket", "batch").agg(F.sum("n_pages").alias("n_pages"), F.sum("n_chars").alias("n_chars"))
    touched = [r[0] for r in sizes.select("bucket").distinct().collect()]        # at most ``buckets`` numbers
    ranked = prefix_rank(sizes, KEYS, "seq", value="n_chars", rank_col="rank", before_col="before")
    if path_exists(spark, f"{path}/state"):
        prior = staged(_state(spark, path).where(F.col("bucket").isin(touched) & (F.col("batch") != batch)).groupBy(*KEYS).agg(
            F.max("last_pos").alias("last"), F.sum("n_chars").alias("chars_so_far")), "prior")
        ranked = ranked.join(prior, _same(ranked, prior), "left").drop(prior[KEYS[0]], prior[KEYS[1]])
    else:
        ranked = ranked.withColumn("last", F.lit(0)).withColumn("chars_so_far", F.lit(0))
    places = staged(ranked.select(
        *KEYS, "seq", (F.coalesce("last", F.lit(0)) + F.col("rank")).cast("long").alias("pos"),
        (F.coalesce("chars_so_far", F.lit(0)) + F.col("before")).cast("long").alias("begins")), "places")
    ends = places.groupBy(*KEYS).agg(F.max("pos").alias("last_pos"))
    kept = broadcast_if_small(places.where(F.col("begins") < max_chars))
    placed = (new.join(kept, _same(new, kept) & new["seq"].eqNullSafe(kept["seq"]))
              .drop(kept[KEYS[0]], kept[KEYS[1]], kept["seq"]))
    _write(placed.select(*KEYS, "pos", "begins", "seq", "url", "method", "data", "bucket", "batch"), f"{path}/pages")
    _write(added.join(ends, _same(added, ends)).drop(ends[KEYS[0]], ends[KEYS[1]])
           .select(*KEYS, "n_pages", "n_chars", "last_pos", "bucket", "batch"), f"{path}/state")


def accumulated_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/pages")


def accumulated_documents(spark: SparkSession, path: str, max_chars: int = K.MAX_TEXT_CHARS) -> DataFrame:
    """One row per (company, run): its kept pages in order, and its text, a space before each page, cut at ``max_chars``.

    Only pages that begin before the cut were kept, so a group holds at most
    ``max_chars`` and one page. ``n_pages`` counts all pages ever pushed.
    """
    state = (_state(spark, path).groupBy(*KEYS)
             .agg(F.sum("n_pages").alias("n_pages"), F.sum("n_chars").alias("total_chars")))
    page = F.struct("pos", "url", "method", "data")
    docs = accumulated_pages(spark, path).groupBy(*KEYS).agg(F.array_sort(F.collect_list(page)).alias("data"))
    text = truncate(F.concat(F.lit(" "), F.array_join(F.transform("data", lambda p: p["data"]), " ")), max_chars)
    return (docs.join(state, _same(docs, state)).drop(state[KEYS[0]], state[KEYS[1]])
            .select(*KEYS, "n_pages", "total_chars", text.alias("text"), "data"))


def company_id_blocks(companies: DataFrame, code: Column, block: int = ID_BLOCK) -> DataFrame:
    """The companies with some url of each code, as blocks of ascending ids.

    Rows (code, block, first_id, n, deltas): the ids are the running sums of
    the differences from ``first_id`` on. A code of any size is many blocks of
    ``block`` ids each, ranked without bringing the code into one task.
    """
    members = companies.where(has_some_url("url")).select(code.alias("code"), "company_id")
    ranked = prefix_rank(members, ["code"], "company_id", rank_col="rank", bounds_from=members.select("company_id"))
    blocks = (ranked.groupBy("code", F.floor((F.col("rank") - 1) / block).cast("int").alias("block"))
              .agg(F.array_sort(F.collect_list("company_id")).alias("ids")))
    later = F.slice("ids", 2, F.size("ids"))
    return blocks.select("code", "block", F.get("ids", F.lit(0)).alias("first_id"), F.size("ids").alias("n"),
                         F.zip_with(later, F.slice("ids", 1, F.size("ids") - 1), lambda b, a: b - a).alias("deltas"))


def decoded_blocks(blocks: DataFrame) -> DataFrame:
    """(code, company_id) of id blocks."""
    ids = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.aggregate(
        F.slice("deltas", F.lit(1), i), F.col("first_id").cast("long"), lambda s, d: s + d))
    return blocks.select("code", F.explode(ids).alias("company_id"))
