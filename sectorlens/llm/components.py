"""Connected components of a stored link table, by alternating stars.

Each round links every node's larger neighbours to the smallest node of its
neighbourhood, then does the same with its smaller neighbours; after a few
rounds (logarithmic in the longest path) every component is a star around its
smallest id. Rounds are stored tables, so the lineage stays short and lost
executors cost one round at most; minima are stored before they are joined,
so adaptive execution can split a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def _minima(pairs: DataFrame) -> DataFrame:
    return stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "minima").withColumnRenamed("u", "w")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component_id) of every id in a link between different ids; the component is its smallest id."""
    edges = stored(links.where(F.col(a) != F.col(b))
                   .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _minima(both)
        large = stored(both.where("v > u").join(low, F.col("u") == F.col("w"))
                       .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "large_star")
        low = _minima(large)
        small = (large.join(low, F.col("u") == F.col("w")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())
        edges = stored(small, "small_star")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)
