"""Fill-in-middle: DuckDB oracle on the table, a regex brute force on odd texts, exact round trips."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sectorlens.llm import q_fim
from sectorlens.llm.fim import Units, draws, fill_in_middle, restore
from sectorlens.llm.registry import QUERIES
from tests.llm.common import SF, docs, duck, same, spark_rows


def units_of(text):
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by plain string work."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    w = units_of(text)
    a, b = sorted((h1 % (len(w) + 1), h2 % (len(w) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(w), "plain", None, None, text
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return len(w), "spm" if h4 % 100 < 20 else "psm", len(p), len(m), out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abYZ@[`{ \n1é€𝄞ß漢\x00\x7f"), max_size=40), max_size=6))
def test_units(texts):
    """Ends of all units of texts that touch each other, against the regular expression."""
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    starts = ends - np.array([len(d) for d in data], dtype=np.int64)
    units = Units(b"".join(data), starts, ends)
    want = [units_of(t) for t in texts]
    assert units.n.tolist() == [len(w) for w in want]
    for k in range(max(map(len, want), default=0) + 1):
        got = units.after(np.minimum(k, units.n)) - starts
        assert got.tolist() == [len("".join(w[:k]).encode()) for w in want]


def test_step_boundaries(monkeypatch):
    monkeypatch.setattr("sectorlens.llm.fim._STEP_WORDS", 2)
    text = "abc dé" * 40
    units = Units(text.encode(), np.array([0]), np.array([len(text.encode())]))
    assert units.n.tolist() == [len(units_of(text))]


ODD = ["", None, "a", "é", "ab" * 9 + "é" * 9, "x <P> y", "x <S y", "<M>", "word, " * 40000, "\n\n a1b2", "漢字かな混じり文 mixed Text",
       "<" * 30, "S>" * 20, "<P" * 20, "𝄞" * 17, "a" * 100_000, "tail<"]


def test_cases(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 5)] + [(7, "same"), (7, "same"), (None, "no id at all"), (-3, "negative id")]
    df = docs(spark, rows).selectExpr("*", "'mine' as form", "1 as n")
    got = fill_in_middle(df, keep=["doc_id", "text", "form"]).withColumn("back", restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(df.limit(0)).count() == 0
    assert "doc_id" not in fill_in_middle(df, keep=["source"]).columns


def test_malformed_bytes(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(x'68FF69C3' AS STRING) AS text UNION ALL SELECT 2L, CAST(x'80808041' AS STRING)")
    made = fill_in_middle(df).withColumn("back", restore(F.col("output"), F.col("form")).cast("binary"))
    assert {r["doc_id"]: bytes(r["back"]) for r in made.collect()} == {1: b"\x68\xff\x69\xc3", 2: b"\x80\x80\x80A"}


def test_draws():
    h = hashlib.sha256(b"1:42").hexdigest()
    assert draws(42) == [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def test_whole_table(spark):
    got = QUERIES["op13_fill_in_middle"](spark, SF)
    same(spark_rows(got), duck(q_fim.ORACLE))
    assert got.where("n < 0 or restored_sha256 is null").count() == 0
