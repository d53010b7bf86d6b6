"""Intermediate tables in the cluster's shared folder, and checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BROADCAST_BYTES = 64 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex[:12]}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what follows survives lost executors without running
    the earlier stages again, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows, counted in bytes, fit ``limit``.

    Beyond the limit the planner joins by shuffle (adaptive execution splits
    hot keys). ``df`` should be a stored table: it is read once for the sum.
    """
    width = F.lit(16)
    for name, kind in df.dtypes:
        size = F.octet_length(F.col(f"`{name}`")) if kind in ("string", "binary") else F.lit(16)
        width = width + F.coalesce(size, F.lit(0))
    total = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= limit else df
