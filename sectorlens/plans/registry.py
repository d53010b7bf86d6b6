"""Registry of named queries: Spark callable + DuckDB oracle SQL.

Every query reads the given tables (or fixture views Spark derives from
them), so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from .oracle import with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an
    optional oracle (fixture views are prefixed automatically)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle, extra)
        return fn
    return deco
