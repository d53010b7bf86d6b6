"""Operator 10: mix sources to target weights.

Tokens are summed per source; a source's share of all tokens follows its
weight but stops at ``cap`` times its own size, the excess going to the
others by weight. Every document is then taken floor(rate) times plus one
copy drawn by a seeded hash with the rate's fraction as probability. All
steps are DataFrame functions; only one small row per source is ever sorted.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a source of size 0 has target 0; a null ``doc_id`` draws by
the digest of its text; repeated rows draw alike; an empty table gives no
rows; input columns named like an output column are replaced by it, those of any
other name stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import broadcast_checked, stored
from .words import WHITESPACE_WORD

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WHITESPACE_WORD)), F.lit(0)).cast("long")


def unit_hash(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the document alone."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.encode(text, "UTF-8")), F.lit(""))
    digits = F.substring(F.md5(F.encode(F.concat(F.lit(seed + ":"), key), "UTF-8")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** 12))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    With sources in ascending order of size / weight those at the cap come
    first, so running sums find the level that the others share by weight.
    The windows see one row per source, pre-aggregated from all documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = per.withColumn("w", weight)
    by_fill = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = left / F.sum("w").over(onward)
    filled = ranked.withColumn("level", level)
    full = F.col("level") * F.col("w") > cap * F.col("source_size")
    common = F.max(F.when(~full, F.col("level"))).over(every)
    target = F.when(full | common.isNull(), (cap * F.col("source_size")).cast("double")).otherwise(common * F.col("w"))
    return filled.select("source", "source_size", F.least(target, (cap * F.col("source_size")).cast("double")).alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` plus size, source_size, target and copies."""
    made = ("size", "source_size", "target", "copies")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = stored(source_targets(sizes, weights, cap), "targets")
    key = "_mix_source"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    other = broadcast_checked(targets.withColumnRenamed("source", key))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn = unit_hash(F.col("doc_id"), F.col("text"), seed) < rate - F.floor(rate)
    return (docs.select(*kept, word_count(F.col("text")).alias("size"))
            .join(other, F.col("source").eqNullSafe(F.col(key)), "left")
            .withColumn("copies", F.floor(rate).cast("int") + F.when(drawn, 1).otherwise(0))
            .drop(key))


def emit(plan: DataFrame) -> DataFrame:
    """Each planned document ``copies`` times, numbered by ``copy`` from 1."""
    return (plan.where(F.col("copies") > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: each document once per copy, numbered by a column ``copy``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "copy"]).alias("row")
    return emit(mix_plan(docs.select(row, "doc_id", "text", "source"))).select("row.*", "copy")
