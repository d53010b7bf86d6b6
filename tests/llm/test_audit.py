"""Filter audit: DuckDB oracle on odd tables and the given one, the walk against counting subset by subset."""

import itertools
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.llm import q_audit
from sectorlens.llm.audit import audit_filters, failures, gray_walk, pieces, step_table, subset_states, word_counts
from sectorlens.llm.registry import QUERIES
from tests.llm.common import SF, docs, duck, same, spark_rows

LABELS = "doc_id bigint, quality int, toxic int"


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=32, max_size=32), st.lists(st.integers(0, 3), min_size=32, max_size=32))
def test_walk(n, good):
    cells = np.array([[n, good, [a * 2 for a in n]], [good, n, n]], dtype=np.int64).transpose(0, 2, 1)
    states = gray_walk(cells)
    for subset in range(32):
        alive = [m for m in range(32) if not m & subset]
        assert (states[:, subset] == cells[:, alive].sum(axis=1)).all()


def test_step_table():
    steps = step_table()
    assert len({s[0] for s in steps}) == 120 and len(steps) == 600
    assert all(bin(b).count("1") == s - 1 and bin(a).count("1") == s and a & b == b for _, s, b, a in steps)
    assert all(a ^ b == 1 << ord(o[s - 1]) - 65 for o, s, b, a in steps)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \t\x0b\x1c\xa0é#", max_size=60), st.integers(1, 9))
def test_words_by_piece(text, size):
    assert b"".join(pieces(text.encode(), size)) == text.encode()
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert word_counts(text.encode()) == (len(words), len(set(words)))


@pytest.mark.parametrize("text, mask", [
    ("", 1), ("w " * 199, 3), ("w " * 200, 2), (" ".join(f"w{i}" for i in range(200)), 0),
    (" ".join(f"w{i % 100}" for i in range(200)), 0), (" ".join(f"w{i % 99}" for i in range(200)), 2), ("é" * 98 + "AB", 1),
    ("é" * 97 + "ABC", 5), ("a|b", 9), ("100%", 9), ("Aé", 5)])
def test_failures(text, mask):
    assert failures(text.encode()) == mask


ROWS = [(0, "x y", "en", "a"), (1, "x y", "en", "b"), (2, "x y", "en", None), (3, None, "en", "a"), (4, "", "en", ""),
        (5, "BIG # text", "en", "a"), (5, "BIG # text", "en", "a"), (6, "BIG # text", "en", "é"), (None, "x y", "en", "a"),
        (None, "no id", "en", "no labels"), (7, "long " * 50000, "en", "b"),
        (8, " ".join(f"w{i}" for i in range(300)), "en", "a"), *[(i, "hot copy", "en", "hot") for i in range(20, 60)]]
MARKS = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (2, 0, 1), (5, 1, 1), (8, 1, 0), (None, 1, 1), (3, None, None), (99, 1, 1), (20, 1, 1), (30, 1, 1)]


def test_cases(spark):
    df = docs(spark, ROWS).selectExpr("*", "'mine' as part", "7 as mask", "8 as good")
    labels = spark.createDataFrame(MARKS, LABELS)
    got = audit_filters(df, labels)
    frame = pd.DataFrame([(i, t, s) for i, t, _, s in ROWS], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    marks = pd.DataFrame(MARKS, columns=["doc_id", "quality", "toxic"]).astype("Int64")
    same(spark_rows(got), duck(q_audit.ORACLE, documents=frame, labels=marks))
    assert got.count() == 600 * 6
    assert audit_filters(df.limit(0), labels).count() == 0
    same(spark_rows(audit_filters(df, labels.limit(0))), duck(q_audit.ORACLE, documents=frame, labels=marks[:0]))


def test_rows_of_zeros(spark):
    """Parts that lose nothing, and one with a single cell: states of all 32 subsets."""
    cells = spark.createDataFrame([("clean", 0, 5, 2, 1), ("one", 31, 3, 0, 3)], "part string, mask int, kept long, good long, toxic long")
    got = {r["part"]: r for r in subset_states(cells).collect()}
    assert got["clean"]["kept"] == [5] * 32 and got["clean"]["good"] == [2] * 32
    assert got["one"]["kept"] == [3] + [0] * 31 and got["one"]["toxic"] == [3] + [0] * 31


def test_whole_table(spark):
    got = QUERIES["op11_filter_audit"](spark, SF)
    same(spark_rows(got), duck(q_audit.ORACLE))
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    by_order = got.groupBy("filter_order").agg({"removed": "sum"}).collect()
    left = got.where("step = 5").groupBy("filter_order").agg({"kept": "sum"}).collect()
    assert {r[0]: r[1] for r in by_order}.keys() == {"".join(p) for p in itertools.permutations("ABCDE")}
    assert {a[1] + dict((r[0], r[1]) for r in left)[a[0]] for a in by_order} == {n}
