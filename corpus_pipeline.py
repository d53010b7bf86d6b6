"""Corpus pipeline over ``documents``: five of the operators, each stage's result a stored table.

Documents that language ID rejects go; of near-duplicates one stays;
documents that hold benchmark passages go; secrets are masked in the texts;
the rest is mixed to the sources' target weights, each document once per copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sectorlens.llm.decontaminate import remove_leaks
from sectorlens.llm.langid import keep_identified
from sectorlens.llm.mixing import mixed
from sectorlens.llm.neardup import keep_one_of_each
from sectorlens.llm.secrets import redact_secrets
from sectorlens.llm.storage import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


STAGES = [("language_id", language_id), ("minhash_near_dedup", near_dedup), ("benchmark_decontamination", decontamination),
          ("secret_scans", secret_scan), ("mixing", mixing)]
#: trained models and entropies have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
