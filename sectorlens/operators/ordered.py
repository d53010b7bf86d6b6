"""Skew-safe order-dependent primitives.

A plain ``row_number() over (partition by key order by o)`` runs each key in
one task; one key holding a third of the rows then becomes one huge task.
``prefix_rank`` gives the same rank (and an exclusive running sum) by cutting
the order column into quantile buckets, so a hot key spans many buckets:
rows are ranked inside each (key, bucket) slice, and the sizes of the
earlier buckets of the same key (a table with at most one row per key and
bucket) are added. The bucket is a deterministic expression of the row, so
re-executed tasks always agree on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def quantile_bucket(df: DataFrame, order: str, n_buckets: int) -> Column:
    """Bucket index (0..n) of ``order`` against approximate global quantiles.

    Computing the bounds is one pass over a single column; the bounds
    (at most ``n_buckets - 1`` numbers) are the only data brought to the
    driver; their error is a fraction of a bucket, however many there are.
    """
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = sorted({float(b) for b in df.approxQuantile(order, probs, min(0.001, 0.25 / n_buckets))}) if probs else []
    if not bounds:
        return F.lit(0)
    v = F.col(order).cast("double")

    def count_le(lo: int, hi: int) -> Column:
        # number of bounds <= v, known to lie in [lo, hi]: balanced CASE tree
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(v >= F.lit(bounds[mid - 1]), count_le(mid, hi)).otherwise(count_le(lo, mid - 1))

    return count_le(0, len(bounds))


def prefix_rank(df: DataFrame, keys: list[str], order: str, value: Column | str | None = None,
                rank_col: str = "rank", before_col: str | None = None,
                n_buckets: int | None = None, bounds_from: DataFrame | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based row number of each row inside ``keys`` by
    the numeric column ``order`` (ascending), and optionally ``before_col`` =
    sum of ``value`` over the earlier rows of the same key.

    ``order`` should be unique within a key for a deterministic rank (ties
    land in the same bucket and are ordered as a plain window would).
    ``bounds_from`` is a cheaper frame with the same ``order`` column to take
    the bucket bounds from (e.g. the base table instead of a joined result);
    any bounds give exact ranks, matching distributions give even buckets.
    """
    spark = df.sparkSession
    if not isinstance(df.schema[order].dataType, NumericType):
        raise TypeError(f"prefix_rank needs a numeric order column, got {df.schema[order].dataType}")
    n_buckets = n_buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    v = F.lit(0) if value is None else (F.col(value) if isinstance(value, str) else value)
    src = bounds_from if bounds_from is not None else df
    # One struct key: NULL fields compare equal inside a struct, so a NULL key
    # is a group of its own, and window, aggregate and join all hash-partition
    # on the same (_key, _b) columns (the ranked side is not shuffled again).
    b = (df.withColumn("_key", F.struct(*keys)).withColumn("_v", v)
           .withColumn("_b", quantile_bucket(src.select(order), order, n_buckets)))

    w_local = Window.partitionBy("_key", "_b").orderBy(order)
    local = (b.withColumn("_lrank", F.row_number().over(w_local))
              .withColumn("_lsum", F.sum("_v").over(w_local.rowsBetween(Window.unboundedPreceding, -1))))

    totals = b.groupBy("_key", "_b").agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_s"))
    w_off = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_key", "_b",
        F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_noff"),
        F.coalesce(F.sum("_s").over(w_off), F.lit(0)).alias("_soff"))

    joined = local.join(offsets, ["_key", "_b"], "inner")
    return joined.select(
        *[c for c in df.columns],
        (F.col("_noff") + F.col("_lrank")).alias(rank_col),
        *([(F.col("_soff") + F.coalesce(F.col("_lsum"), F.lit(0))).alias(before_col)]
          if before_col else []),
    )


#: Largest dimension, in bytes as the planner knows them, that is ever broadcast.
BROADCAST_MAX_BYTES = 64 << 20


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` by the planner's statistics: file sizes at a scan, an
    upper bound (often a loose one) after joins. No job is started."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Deal an input of few bytes (one small file is one partition) over the
    cores before heavy per-row work. An input above ``max_bytes`` is worked on
    where it is read: its pages or texts are never shuffled for this."""
    if df.isStreaming or planned_bytes(df) > max_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_bytes`` by the planner's statistics."""
    return planned_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when the planned size is within ``max_bytes``.

    Otherwise ``df`` is returned as is, and adaptive execution decides from
    the sizes it meets at run time.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def top_k_per_key(df: DataFrame, keys: list[str], order: list, k: int, salt_on: str,
                  salts: int = 64, rank_col: str = "rank") -> DataFrame:
    """Exact top-``k`` rows per key by ``order``, safe for hot keys.

    Stage 1 keeps the top ``k`` inside each (key, salt) slice, so a hot key
    is cut into ``salts`` parallel windows; stage 2 ranks at most
    ``salts * k`` survivors per key. ``k`` is a small report size.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_on)), F.lit(salts)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order_cols)
    pre = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*order_cols)
    return pre.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)
