"""Queries for sources, sinks and the incremental ingest: S01-S07, S10, X01.

Each call writes under a fresh folder in the cluster's shared checkpoint
folder (``spark.checkpoint.dir``) and reads the result back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.urls import with_registered_domain
from ..operators import dataset as D
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources import tables as S
from ..streaming.ingest import ingest_new_pages
from .q_dataset import _pipe, extracted
from .registry import query


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/sectorlens-io/{name}-{uuid.uuid4().hex}"


def _dump_pages(spark, sf, path, cond=None):
    p = fx.v_scraped(spark, sf)
    if cond is not None:
        p = p.filter(cond)
    p.select("label", "url", "raw_html").write.mode("append").json(path)


@query("s01_read_page_dump", "SELECT label, url, md5(raw_html) AS html_md5 FROM v_scraped")
def s01(spark, sf):
    path = _scratch(spark, "s01")
    _dump_pages(spark, sf, path)
    return S.read_page_dump(spark, path).select("label", "url", F.md5("raw_html").alias("html_md5"))


_HOST = "lower(regexp_extract(url, '^(?:[^:/?#]+:)?//(?:[^@/?#]*@)?([^:/?#]*)', 1))"


@query("s02_write_pages_file_key",
       f"""SELECT url, concat(regexp_extract(host, '([^.]+)\\.[^.]+$', 1), '_', regexp_extract(host, '([^.]+)$', 1),
       '_2024-03-01T000000') AS file_key FROM (SELECT url, {_HOST} AS host FROM v_scraped)""")
def s02(spark, sf):
    path = _scratch(spark, "s02")
    p = with_registered_domain(fx.v_scraped(spark, sf).select("label", "url", "raw_html"), "url")
    p = p.withColumn("scraped_at", F.lit("2024-03-01 00:00:00").cast("timestamp")) \
         .withColumn("file_key", S.file_key("domain", "suffix", "scraped_at"))
    S.write_pages(p.select("label", "url", "raw_html", "file_key"), path, fmt="parquet")
    return spark.read.parquet(path).select("url", "file_key")


@query("s03_read_code_list", "SELECT DISTINCT branch_codes[1] AS sni_code FROM v_companies")
def s03(spark, sf):
    path = _scratch(spark, "s03")
    codes = fx.v_companies(spark, sf).select(D.primary_code().alias("value")).distinct()
    codes.write.mode("overwrite").text(path)
    return S.read_code_list(spark, path)


@query("s04_init_if_empty",
       "SELECT DISTINCT municipality_code AS code, municipality AS name FROM v_companies")
def s04(spark, sf):
    """Initialise the municipality dimension (derived from the register)
    only while the table is missing or empty."""
    path = _scratch(spark, "s04")
    dim = fx.v_companies(spark, sf).select(F.col("municipality_code").alias("code"),
                                           F.col("municipality").alias("name")).distinct()
    S.init_if_empty(dim, path)
    S.init_if_empty(dim, path)          # second call must not write again
    return spark.read.parquet(path)


@query("s05_backup_restore",
       "SELECT company_id, org_nr FROM v_companies UNION ALL SELECT company_id, org_nr FROM v_companies")
def s05(spark, sf):
    live = _scratch(spark, "s05-live")
    bak = _scratch(spark, "s05-bak")
    fx.v_companies(spark, sf).select("company_id", "org_nr").write.parquet(live)
    S.backup(spark, {"companies": live}, bak)
    S.restore(spark, {"companies": live}, bak)
    return spark.read.parquet(live)


@query("s06_split_table_fetch", "SELECT company_id FROM splits WHERE split = 'dev'", extra=_pipe("splits"))
def s06(spark, sf):
    path = _scratch(spark, "s06")
    s = D.split_assignment(fx.v_companies(spark, sf), extracted(spark, sf))
    for name in ("train", "dev", "test"):
        S.insert_split(s.filter(F.col("split") == name).drop("split").select("company_id"), path, name)
    return S.fetch_split(spark, path, "dev").select("company_id")


@query("s06_split_table_delete", "SELECT company_id, split FROM splits WHERE split <> 'test'", extra=_pipe("splits"))
def s06d(spark, sf):
    path = _scratch(spark, "s06d")
    s = D.split_assignment(fx.v_companies(spark, sf), extracted(spark, sf))
    s.select("company_id", "split").write.partitionBy("split").parquet(path)
    S.delete_split(spark, path, "test")
    return spark.read.parquet(path).select("company_id", "split")


@query("s06_split_table_delete_all", "SELECT company_id, split FROM splits WHERE split = 'dev'", extra=_pipe("splits"))
def s06a(spark, sf):
    """Everything is deleted, then one split is inserted again."""
    path = _scratch(spark, "s06a")
    s = D.split_assignment(fx.v_companies(spark, sf), extracted(spark, sf)).select("company_id", "split")
    s.write.partitionBy("split").parquet(path)
    S.delete_all_splits(s, path)
    S.insert_split(s.filter("split = 'dev'").drop("split"), path, "dev")
    return spark.read.parquet(path).select("company_id", "split")


@query("s07_write_corpora",
       "SELECT company_id, split, n_chars FROM corpus", extra=_pipe("corpus"))
def s07(spark, sf):
    path = _scratch(spark, "s07")
    ds = D.build_dataset(fx.v_companies(spark, sf), extracted(spark, sf))
    S.write_corpora(D.build_corpus(ds), path)
    return spark.read.parquet(path).select("company_id", "split", F.col("n_chars").cast("long").alias("n_chars"))


@query("s10_scraped_urls", "SELECT DISTINCT url FROM v_scraped")
def s10(spark, sf):
    path = _scratch(spark, "s10")
    _dump_pages(spark, sf, path)
    return S.scraped_urls(spark, path)


@query("x01_incremental_ingest",
       """SELECT label, url, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 2 END AS run_id FROM (
  SELECT label, url, page_id, row_number() OVER (PARTITION BY url ORDER BY page_id % 2, label) AS rn FROM v_scraped)
WHERE rn = 1""")
def x01(spark, sf):
    """Two runs over a growing page folder: the second sees all files but
    only processes urls that the first did not store."""
    src = _scratch(spark, "x01-in")
    out = _scratch(spark, "x01-out")
    ck = _scratch(spark, "x01-ck")
    _dump_pages(spark, sf, src, F.col("page_id") % 2 == 0)
    ingest_new_pages(spark, src, out, ck, run_id=1)
    _dump_pages(spark, sf, src, F.col("page_id") % 2 == 1)
    ingest_new_pages(spark, src, out, ck, run_id=2)
    return spark.read.parquet(out).select("label", "url", "run_id")


@query("x01_repeated_and_null",
       """SELECT label, url, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 2 END AS run_id FROM (
  SELECT CASE WHEN page_id % 5 = 0 THEN NULL ELSE label END AS label, url, page_id FROM v_scraped) s
WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id % 2, label NULLS LAST) = 1""")
def x01_repeated(spark, sf):
    """Every record twice in its file, a fifth of the labels missing, the first run's pages in the second run again."""
    src, out, ck = _scratch(spark, "x01r-in"), _scratch(spark, "x01r-out"), _scratch(spark, "x01r-ck")
    p = fx.v_scraped(spark, sf).withColumn("label", F.when(F.col("page_id") % 5 != 0, F.col("label")))
    for run_id, cond in ((1, F.col("page_id") % 2 == 0), (2, F.lit(True))):
        twice = p.filter(cond).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))   # written where the page is read
        twice.select("label", "url", "raw_html").write.mode("append").json(src)
        ingest_new_pages(spark, src, out, ck, run_id=run_id)
    return spark.read.parquet(out).select("label", "url", "run_id")
