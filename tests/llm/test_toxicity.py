"""Toxicity: windows and passages against plain restatements, scores against a row-by-row version, held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.llm import toxicity as X
from sectorlens.llm.catalog import QUERIES
from tests.llm.common import SF, docs

INSULTS = ["grumblehead", "snotface", "vilemuck"]


def prose(rng, n, insults=0):
    words = ["".join(rng.choice(["la", "to", "ren", "is", "mo", "da", "ke", "ul"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for _ in range(insults):
        words[rng.randrange(n)] = rng.choice(INSULTS)
    return " ".join(words)


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        rows.append((i, prose(rng, rng.randint(20, 200), 3 * toxic)))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    df, marks = docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return df, marks, X.fit(df, marks), dict(labels), dict(rows)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aB \t\n\xa0é", max_size=200), st.integers(1, 30))
def test_windows(text, size):
    """Windows do not depend on where a text was cut into pieces."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    want = [b" %b " % b" ".join(words[i:i + 8]) for i in range(0, len(words), 8)]
    old = X.pieces.__defaults__
    X.pieces.__defaults__ = (size,)
    try:
        assert [w for part in X.window_lists(text.encode()) for w in part] == want
    finally:
        X.pieces.__defaults__ = old


def test_triples_ignore_copies():
    once = X.distinct_triples([b"a b c", b"b c d"])
    assert once == X.distinct_triples([b"a b c", b"a b c", b"A  B c", b"b c d"])
    assert once == {b"a": 1, b"b": 2, b"c": 2, b"d": 1}


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 50), st.integers(0, 50), st.integers(0, 50), st.integers(0, 50))
def test_g_test(a, more, b, rest):
    n, m = a + more, b + rest + 1
    table = np.array([[a, n - a], [b, m - b]], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    want = 2 * sum(o * np.log(o / e) for o, e in zip(table.ravel(), expected.ravel()) if o)
    assert X._g_test(a, n, b, m) == pytest.approx(want, abs=1e-9)


def test_best_cut():
    z, y = np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 0])
    assert X.best_cut(z, y) == 1.5
    assert X.best_cut(np.zeros(9), np.array([1] + [0] * 8)) > 0
    assert X.best_cut(np.array([1.0, 1.0]), np.array([1, 1])) < 1


def test_lengths_are_frames():
    """Lengths equal those of one call per window."""
    content = b" some ordinary words of prose " * 40
    windows = [b" ordinary words ", b" zq zq zq ", "é ".encode() * 30]
    compressor = X.Compressor(content)
    one = [len(compressor.compressor.compress(X.CARRIER + w)) for w in windows]
    assert compressor.lengths(windows).tolist() == one


def test_few_samples():
    assert X.train_dictionary([b"ab", b"cd"], 3, 64) == b"abc"
    assert X.train_dictionary([], 100, 64) == b""
    with pytest.raises(zstandard.ZstdError):
        zstandard.train_dictionary(4, [b"ab", b"cd"])


def test_held_out_accuracy(spark, fitted):
    df, _, model, labels, texts = fitted
    got = X.score_toxicity(df, model).withColumn("held", X.held_out(X.F.col("doc_id"))).collect()
    held = [r for r in got if r["held"]]
    assert {r["doc_id"] for r in held} == {i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right >= 0.95 * len(held)
    hit = [r for r in held if labels[r["doc_id"]] and r["predicted"]]
    for r in hit:       # the passages hold insults
        words = texts[r["doc_id"]].split()
        assert any(w in INSULTS for p in r["passages"] for w in words[p["start"]:p["end"]])


def test_scores_by_hand(spark, fitted):
    """The job's scores against windows compressed one by one."""
    df, _, model, _, texts = fitted
    got = {r["doc_id"]: r for r in X.score_toxicity(df.where("doc_id < 40"), model).collect()}
    base, toxic = model.compressors()
    for i in range(40):
        words = texts[i].lower().encode().split()
        windows = [X.CARRIER + b" %b " % b" ".join(words[k:k + 8]) for k in range(0, len(words), 8)]
        gains = [len(base.compressor.compress(w)) - len(toxic.compressor.compress(w)) for w in windows]
        x = np.array([sum(gains), *[sum(g >= t for g in gains) for t in X.GAINS]]) / max(1, len(gains))
        z = float(x / model.scale @ model.weights[:-1] + model.weights[-1])
        assert got[i]["score"] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-9)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)
        assert [(p["start"], p["gain"]) for p in got[i]["passages"]] == [(8 * k, g) for k, g in enumerate(gains) if g >= X.GAINS[1]]


def test_cases(spark, fitted):
    _, _, model, _, _ = fitted
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "x" * 300_000), (4, "la to ren " * 100_000), (5, "grumblehead " * 9), (5, "grumblehead " * 9),
            (None, "no id")]
    df = docs(spark, rows).selectExpr("*", "'mine' as score", "1 as passages")
    got = X.score_toxicity(df, model, keep=["doc_id", "source"]).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["score"] == by_id[1]["score"] == by_id[2]["score"] < 0.5 and by_id[5]["predicted"] == 1
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    assert X.score_toxicity(df.limit(0), model).count() == 0
    bad = spark.sql("SELECT 1L AS doc_id, CAST(x'68FF69C320' AS STRING) AS text")
    assert X.score_toxicity(bad, model).count() == 1


@pytest.mark.parametrize("labels, want", [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([(1, None), (2, 5)], 0.0)])
def test_one_class_only(spark, labels, want):
    df = docs(spark, [(i, f"text {i}") for i in range(1, 4)])
    model = X.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    trained = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 != 0}
    assert {r["score"] for r in X.score_toxicity(df, model).collect()} == {want if trained else 0.0}


def test_sample_bound(spark):
    rows = [(i, "w" * 1000) for i in range(600)]
    df, marks = docs(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id bigint, toxic int")
    taken = X.training_rows(df, marks, sample_bytes=50_000)
    for label in (0, 1):
        for use in (True, False):
            assert 20 <= sum(1 for _, y, c in taken if (y, c) == (label, use)) <= 85
    assert taken == X.training_rows(df.repartition(7), marks, sample_bytes=50_000)


def test_whole_table(spark):
    got = QUERIES["op12_toxicity"](spark, SF).collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == n and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert got == QUERIES["op12_toxicity"](spark, SF).collect()


def test_accuracy_of_given_table(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op12_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    toxic, said = got["toxic"] == 1, got["predicted"] == 1
    assert (toxic & said).sum() >= 0.7 * toxic.sum() and (~toxic & said).sum() <= 0.04 * (~toxic).sum()
