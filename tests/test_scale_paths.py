"""The paths taken beyond the broadcast bounds give the same results."""

from pyspark.sql import functions as F

from sectorlens.operators.dataset import extraction_job
from sectorlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.select("company_id", "seq", "url", F.md5("data")).collect())


def test_extraction_job_shuffle_path(spark):
    pages, comp = fx.v_scraped(spark, SF_SMALL), fx.v_companies(spark, SF_SMALL)
    small = extraction_job(pages, comp, "2024-03-01 00:00:00")
    big = extraction_job(pages, comp, "2024-03-01 00:00:00", max_broadcast_bytes=0)
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin LeftSemi" not in plan      # no pre-parse broadcast filter
    assert _rows(small) == _rows(big)


def test_parse_on_a_stream(spark, tmp_path):
    """parse_pages and the text expressions work on a streaming frame."""
    from sectorlens import schemas
    from sectorlens.operators import html as H
    src = str(tmp_path / "in")
    fx.v_scraped(spark, SF_SMALL).select("label", "url", "raw_html").write.json(src)
    stream = spark.readStream.schema(schemas.SCRAPED_PAGE_JSON).json(src)
    parsed = H.parse_pages(stream, html_col="raw_html", keep=["url"], parts=("nodes", "metas"))
    q = (parsed.select("url", H.page_text().alias("t")).writeStream.format("memory")
         .queryName("parsed_pages").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT count(*) AS n FROM parsed_pages").first()["n"] == fx.v_scraped(spark, SF_SMALL).count()


def test_link_pages_of_one_row_group_are_parsed_by_many_tasks(spark):
    """j11 and h14: the customers come from one row group, their pages' parse is dealt out."""
    from sectorlens.plans import q_crawl
    tasks = q_crawl._link_pages(spark, SF_SMALL).select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
