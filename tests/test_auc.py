"""A11 against a plain restatement: every positive against every negative."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorlens.operators import evaluate as V

SCHEMA = "doc_id long, true_label string, label string, score double"


def brute(rows):
    """{label: (npos, nneg, auc)}; null below all scores, NaN above."""
    key = lambda s: (0, 0.0) if s is None else (2, 0.0) if math.isnan(s) else (1, s)
    out = {}
    for label in {r[2] for r in rows}:
        pos = [key(r[3]) for r in rows if r[2] == label and label is not None and r[1] == label]
        neg = [key(r[3]) for r in rows if r[2] == label and (label is None or r[1] != label)]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        out[label] = (len(pos), len(neg), wins / (len(pos) * len(neg)) if pos and neg else None)
    return out


def check(spark, rows, **kw):
    per, macro = V.label_auc(spark.createDataFrame(rows, SCHEMA), **kw)
    got = {r["label"]: (r["npos"], r["nneg"], r["auc"]) for r in per.collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for label, (npos, nneg, auc) in want.items():
        assert got[label][:2] == (npos, nneg)
        assert (got[label][2] is None) == (auc is None)
        assert auc is None or got[label][2] == pytest.approx(auc, abs=1e-12)
    known = [a for *_, a in want.values() if a is not None]
    found = macro.first()["macro_auc"]
    assert found == (pytest.approx(np.mean(known)) if known else None)


@pytest.mark.parametrize("bins", [4, 4096])
def test_ties_ends_and_nulls(spark, bins):
    values = [0.0, 1.0, 0.5, 0.5, None, math.nan, -3.0, 7.0, 1e-300, 1 - 1e-16, 0.5 + 1e-9]
    rng = np.random.default_rng(5)
    rows = [(i, ["a", "b", "c", None][int(rng.integers(4))], lab, values[int(rng.integers(len(values)))])
            for i in range(60) for lab in ("a", "b", "c", "never", None)]
    check(spark, rows, bins=bins)
    check(spark, rows + rows, bins=bins)


def test_empty_and_one_class(spark):
    check(spark, [])
    check(spark, [(1, "a", "a", 0.2), (2, "a", "a", 0.3)])


def test_all_scores_in_one_bin(spark, monkeypatch):
    """A hot bin: nothing is told apart by the histogram, all by the ranks."""
    rows = [(i, "a" if i % 3 else "b", "a", 0.5 + i * 1e-9) for i in range(500)]
    check(spark, rows)
    monkeypatch.setattr(V, "planned_bytes", lambda df: 1 << 30)     # the same in many slices
    check(spark, rows)


def test_many_labels_shuffle_few_rows(spark):
    """822 labels: the scores ranked one by one are a small part of documents x labels."""
    labels, docs = 822, 400
    z = np.random.default_rng(7).normal(size=(docs, labels)) * 2
    true = np.arange(docs) % labels
    z[np.arange(docs), true] += 6
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    wide = spark.createDataFrame([(i, f"l{true[i]}", p[i].tolist()) for i in range(docs)], "doc_id long, true_label string, s array<double>")
    pred = wide.select("doc_id", "true_label", F.posexplode("s").alias("at", "score")).select(
        "doc_id", "true_label", F.concat(F.lit("l"), "at").alias("label"), "score")
    hist = V.score_histogram(pred)
    assert hist.agg(F.sum(F.col("npos") + F.col("nneg"))).first()[0] == labels * docs
    assert V.tied_scores(pred, hist).count() < labels * docs / 50
    got = {r["label"]: r["auc"] for r in V.label_auc(pred)[0].collect()}
    assert len(got) == labels and sum(a is not None for a in got.values()) == docs
    for k in range(0, docs, 37):
        own, rest = p[k, k], np.delete(p[:, k], k)
        assert got[f"l{k}"] == pytest.approx(((own > rest) + 0.5 * (own == rest)).mean(), abs=1e-12)
