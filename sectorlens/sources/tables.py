"""Scans and sinks.

Tables are columnar Parquet; JSON page dumps are read with an explicit
schema (no inference pass over 100 TB of HTML).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_page_dump(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A folder of JSON page files ``{label, url, raw_html}``.

    Files holding one single-line object (as a page dump writes them) and
    JSON-lines files are both read line-wise, which keeps files splittable;
    ``multi_line`` reads pretty-printed one-object files instead. The source
    file is kept as provenance (``_metadata.file_path``).
    """
    df = (spark.read.schema(schemas.SCRAPED_PAGE_JSON)
          .option("multiLine", str(multi_line).lower()).json(path))
    return df.select("label", "url", "raw_html",
                     F.col("_metadata.file_path").alias("source_file"))


def file_key(domain: str = "domain", suffix: str = "suffix", ts: str = "scraped_at"):
    """S02 file key ``{domain}_{suffix}_{yyyy-MM-ddTHHmmss}``."""
    return F.concat_ws("_", F.col(domain), F.col(suffix),
                       F.date_format(F.col(ts), "yyyy-MM-dd'T'HHmmss"))


def write_pages(pages: DataFrame, path: str, fmt: str = "json") -> None:
    """Append scraped pages; rows are the unit, not files."""
    pages.write.mode("append").format(fmt).save(path)


def read_dimension_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """Dimension table stored as a JSON array file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_code_list(spark: SparkSession, path: str) -> DataFrame:
    """One code per line (all industry codes)."""
    return spark.read.text(path).select(F.trim("value").alias("sni_code")).filter("sni_code != ''")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system; read faults are raised, not taken for an absent table."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def init_if_empty(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write ``df`` only if the table at ``path`` is missing or empty."""
    spark = df.sparkSession
    if path_exists(spark, path) and not spark.read.schema(df.schema).format(fmt).load(path).isEmpty():
        return False
    df.write.mode("append").format(fmt).save(path)
    return True


def backup(spark: SparkSession, tables: dict[str, str], backup_dir: str) -> None:
    """Snapshot every table to ``backup_dir/<name>``."""
    for name, path in tables.items():
        spark.read.parquet(path).write.mode("overwrite").parquet(f"{backup_dir}/{name}")


def restore(spark: SparkSession, tables: dict[str, str], backup_dir: str) -> None:
    """Restore by appending the snapshot to the live table."""
    for name, path in tables.items():
        spark.read.parquet(f"{backup_dir}/{name}").write.mode("append").parquet(path)


# --- S06: the split table (one parquet dataset partitioned by ``split``) ---

def insert_split(df: DataFrame, path: str, split: str) -> None:
    df.withColumn("split", F.lit(split)).write.mode("append").partitionBy("split").parquet(path)


def fetch_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Partition-pruned read of one split."""
    return spark.read.parquet(path).filter(F.col("split") == split)


def delete_split(spark: SparkSession, path: str, split: str) -> None:
    """Drop one split: remove its partition folder (no data is rewritten)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    part = jvm.org.apache.hadoop.fs.Path(f"{path}/split={split}")
    fs = part.getFileSystem(conf)
    if fs.exists(part):
        fs.delete(part, True)


def delete_all_splits(df_schema_source: DataFrame, path: str) -> None:
    """Empty the table whatever partition-overwrite mode the session has."""
    df_schema_source.limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("split").parquet(path)


def write_corpora(corpus: DataFrame, path: str) -> None:
    """Replace the three corpora in one partitioned write."""
    corpus.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("split").parquet(path)


def scraped_urls(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every url already stored (only the url field is parsed)."""
    url_only = schemas.SCRAPED_PAGE_JSON["url"]
    from pyspark.sql import types as T
    return (spark.read.schema(T.StructType([url_only])).option("multiLine", str(multi_line).lower())
            .json(path).select("url").distinct())
