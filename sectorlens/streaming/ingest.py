"""Incremental page ingest with Structured Streaming.

New page files in a folder are picked up by a file stream; each micro-batch
is de-duplicated by url and freed of the urls already stored, so a re-run
only processes pages never seen before. Stored urls lie in a ``UrlStore``
beside the output (no unbounded streaming state), of which a batch reads only
the buckets that can match. The checkpoint location makes the ingest
exactly-once across restarts and lost executors: a batch first lists its new
urls as a generation of the store, then appends their rows; if it is repeated,
it finds its generation and appends what the output lacks of it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .. import schemas
from ..sources.tables import path_exists
from ..sources.urlstore import UrlStore


_ROW = ("url", "label", "source_file", "html_key")


def _stored_urls(spark: SparkSession, out_path: str) -> DataFrame:
    if not path_exists(spark, out_path):
        return spark.createDataFrame([], "url string")
    return spark.read.parquet(out_path).select("url").distinct()


def _same_row(a: DataFrame, b: DataFrame):
    cond = a["url"] == b["url"]
    for c in _ROW[1:]:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def ingest_new_pages(spark: SparkSession, in_dir: str, out_path: str, checkpoint: str,
                     transform=None, run_id: int = 0, max_files_per_batch: int = 10_000,
                     store: UrlStore | None = None) -> None:
    """Process every page file not processed before, then stop
    (``availableNow``). ``transform`` maps a batch of new pages
    ``(label, url, raw_html)`` to the rows to append (default: as is).

    Per micro-batch (bounded by ``max_files_per_batch``) one page per url is
    chosen on keys alone: url, label, file and a digest of the page, compared
    null-safe, smallest first (no label last). Urls already stored are dropped
    from the keys, which are kept on disk for the batch; the pages follow by a
    semi-join. Only records repeated within a file are de-duplicated as rows.
    A page without a url cannot be known again and is left out. ``store``
    defaults to the folder ``<out_path>_urls``; an output without one gives
    its urls to it first.
    """
    spark_now = SparkSession.active()
    store = store or UrlStore(spark_now, f"{out_path.rstrip('/')}_urls")
    stream_key = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    if not store.generations() and path_exists(spark_now, out_path):
        store.add(_stored_urls(spark_now, out_path), "adopted")
    stream = (spark.readStream.schema(schemas.SCRAPED_PAGE_JSON)
              .option("maxFilesPerTrigger", max_files_per_batch).json(in_dir)
              .withColumn("source_file", F.col("_metadata.file_path")))

    def batch(df: DataFrame, epoch: int) -> None:
        df = df.filter("url is not null").withColumn("html_key", F.md5("raw_html"))
        first = F.min(F.struct(F.col("label").isNull().alias("unlabelled"), *_ROW[1:], "n")).alias("k")
        keys = (df.groupBy(*_ROW).agg(F.count(F.lit(1)).alias("n"))
                .groupBy("url").agg(first).select("url", *[F.col(f"k.{c}").alias(c) for c in (*_ROW[1:], "n")])
                .persist(StorageLevel.DISK_ONLY))
        gen = f"{stream_key}-{epoch}"
        repeated = store.has(gen)
        if not repeated:
            store.merge()
            store.add(keys.select("url").join(store.seen(keys), "url", "left_anti"), gen)
        mine = store.generation(gen)
        if repeated:
            mine = mine.join(_stored_urls(df.sparkSession, out_path), "url", "left_anti")
        fresh = keys.join(mine, "url", "left_semi")
        once, often = fresh.filter("n = 1"), fresh.filter("n > 1")
        new = (df.join(once, _same_row(df, once), "left_semi")
               .unionByName(df.join(often, _same_row(df, often), "left_semi").dropDuplicates(["url"]))
               .select("label", "url", "raw_html"))
        rows = transform(new) if transform else new
        rows.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(out_path)
        keys.unpersist()

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
