"""Mixing: DuckDB oracle on odd tables, water-filling against repeated resharing, copies against the seeded hash."""

import hashlib
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sectorlens.llm import q_mixing
from sectorlens.llm.mixing import CAP, SEED, emit, mix_plan, source_targets
from sectorlens.llm.registry import QUERIES
from tests.llm.common import SF, docs, duck, same, spark_rows


def reshare(sizes, weights):
    """Targets by resharing the excess until none is above the cap."""
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(CAP * sizes[s] for s in full)
        w = sum(weights[s] for s in sizes if s not in full)
        target = {s: float(CAP * sizes[s]) if s in full else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > CAP * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def brute(rows):
    """(doc_id, size, source_size, target, copies) of rows (doc_id, text, source)."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows if s is not None}) + [None] * any(s is None for *_, s in rows)
    weights = {s: 1 + i % 3 for i, s in enumerate(sources)}
    per = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    target = reshare(per, weights)
    out = []
    for (i, t, s), n in zip(rows, size):
        rate = target[s] / per[s] if per[s] else 0.0
        key = str(i) if i is not None else hashlib.md5(t.encode()).hexdigest() if t is not None else ""
        u = int(hashlib.md5(f"{SEED}:{key}".encode()).hexdigest()[:12], 16) / 16 ** 12
        out.append((i, n, per[s], target[s], int(rate) + (u < rate - int(rate))))
    return out


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.integers(0, 50), min_size=1))
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r[0]: r[2] for r in source_targets(df).collect()}
    want = reshare(sizes, {s: 1 + i % 3 for i, s in enumerate(sorted(sizes))}) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


ROWS = [(i, "w " * (i % 9), "en", s) for i, s in enumerate(["a", "b", "é", "Z", None, "a", "a", "", "hot", *["hot"] * 40])]
ROWS += [(None, None, None, None), (None, "x y", "en", "a"), (3, "dup", "en", "Z"), (3, "dup", "en", "Z"), (99, "l " * 50000, "en", "b"),
         (100, None, "en", "empty")]


def test_cases(spark):
    frame = pd.DataFrame([(i, t, s) for i, t, _, s in ROWS], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    df = docs(spark, ROWS).selectExpr("*", "'mine' as target", "0 as copies")
    plan = mix_plan(df)
    got = plan.selectExpr("doc_id", "size", "source_size", "target", "size * copies as taken")
    same(spark_rows(got), duck(q_mixing.ORACLE, documents=frame))
    key = lambda r: [str(x) for x in r]
    want = sorted(brute([(i, t, s) for i, t, _, s in ROWS]), key=key)
    assert sorted([(r["doc_id"], r["copies"]) for r in plan.collect()], key=key) == sorted([(w[0], w[4]) for w in want], key=key)
    assert emit(plan).count() == sum(w[4] for w in want)
    assert mix_plan(df.limit(0)).count() == 0


def test_whole_table(spark):
    got = QUERIES["op10_mixing"](spark, SF)
    same(spark_rows(got), duck(q_mixing.ORACLE))


def test_column_named_like_the_join_key(spark):
    rows = [(i, "a b c", "xy"[i % 2]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = df.withColumn("_mix_source", F.lit("mine")).withColumn("_MIX_source_", F.lit(1))
    plain = {r["doc_id"]: (r["target"], r["copies"]) for r in mix_plan(df).collect()}
    got = mix_plan(clash).collect()
    assert {r["doc_id"]: (r["target"], r["copies"]) for r in got} == plain
    assert all(r["_mix_source"] == "mine" and r["_MIX_source_"] == 1 for r in got)
