"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import q_crawl, q_dataset, q_eval, q_html, q_io, q_learn, q_registry  # noqa: F401
from .registry import ORACLES, QUERIES


def all_queries():
    return QUERIES


def all_oracles():
    return ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.dataset import extraction_job, split_assignment
    from ..sources import fixtures as fx
    comp = fx.v_companies(spark, sf_dir)
    ext = extraction_job(fx.v_scraped(spark, sf_dir), comp, "2024-03-01 00:00:00")
    split = split_assignment(comp, ext)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n_companies"))
