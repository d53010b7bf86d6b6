"""The sharded softmax learner against plain NumPy, its optimum, restarts, hot features and 822 classes."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorlens.operators import learn as L
from sectorlens.operators import sharded as S
from sectorlens.sources import fixtures as fx
from tests.conftest import SF_SMALL

CLASSES = ["a", "b", "c", "d", "e"]
DOCS = "doc_id bigint, true_label string, text string"


def matrix(texts, buckets):
    x = np.zeros((len(texts), buckets + 1))
    for i, t in enumerate(texts):
        for w in re.findall(r"\w+", (t or "").lower()):
            x[i, int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % buckets] += 1
        x[i] /= np.linalg.norm(x[i]) or 1.0
        x[i, buckets] = 1.0
    return x


def fit(x, y, classes, reg, rounds):
    """(weights, loss before each round) of the same steps on dense arrays."""
    n, d = len(x), x.shape[1]
    regs = np.full((d, 1), reg)
    regs[-1] = 0
    bound = (np.abs(x) * np.abs(x).sum(axis=1, keepdims=True)).sum(axis=0)[:, None] / (2 * n) + regs
    w = u = np.zeros((d, classes))
    losses, t = [], 1.0
    for _ in range(rounds):
        z = x @ u
        lse = np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1)
        losses.append(float((lse - z[np.arange(n), y]).mean()))
        p = np.exp(z - lse[:, None])
        p[np.arange(n), y] -= 1
        new = u - np.divide(x.T @ p / n + regs * u, bound, out=np.zeros_like(u), where=bound > 0)
        t, last = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        u, w = new + (last - 1) / t * (new - w), new
    return w, losses


def generated(n=60, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        c = int(rng.integers(0, 5))
        words = [f"w{rng.integers(0, 30)}" for _ in range(rng.integers(0, 25))] + [f"own{c}"] * int(rng.integers(0, 3)) + ["hot"] * 5
        rows.append((i, CLASSES[c], " ".join(words)))
    return rows + [(n, "a", ""), (n + 1, "b", None), (n + 2, None, "no label"), (n + 3, "c", "hot " * 5000)]


@pytest.mark.parametrize("setting", [dict(span=8, width=2, tile_bytes=1 << 20), dict(span=4, width=5, tile_bytes=1200, tiles_per_lane=2)])
def test_equals_numpy(spark, monkeypatch, setting):
    """Weights, losses and probabilities to 1e-9, in one tile or many tiles, lanes and levels of sums."""
    monkeypatch.setattr(S, "FAN_IN", 2)
    rows, buckets, rounds, reg = generated(), 32, 4, 0.01
    model = S.train(spark.createDataFrame(rows, DOCS).repartition(3), rounds, regs=[reg], buckets=buckets, **setting)
    known = [r for r in rows if r[1] is not None]
    x, y = matrix([r[2] for r in known], buckets), np.array([CLASSES.index(r[1]) for r in known])
    w, losses = fit(x, y, 5, reg, rounds)
    got = np.zeros_like(w)
    for r in S.weights(model).where(f"feature <= {buckets}").collect():
        got[r["feature"], CLASSES.index(r["label"])] = r["w"]
    assert np.abs(got - w).max() < 1e-9
    assert [loss for _, _, loss in model.losses] == pytest.approx(losses, abs=1e-9)
    z = matrix([r[2] for r in rows], buckets) @ w
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    probs = {r["doc_id"]: r["probs"] for r in S.probabilities(model, spark.createDataFrame(rows, DOCS), tile_bytes=2000,
                                                               tiles_per_lane=1).collect()}
    assert len(probs) == len(rows) and max(np.abs(np.array(probs[i]) - p[i]).max() for i in range(len(rows))) < 1e-9


def test_joint_features_equal_numpy(spark):
    """Words and a vector with negative numbers in one model; null vectors count as zeros."""
    rng = np.random.default_rng(11)
    rows = [(*r, None if i % 9 == 0 else rng.normal(size=3).tolist()) for i, r in enumerate(generated())]
    docs = spark.createDataFrame(rows, DOCS + ", vec array<double>").repartition(3)
    buckets, rounds, reg = 16, 4, 0.02
    model = S.train(docs, rounds, regs=[reg], buckets=buckets, span=4, width=2, tile_bytes=1500, tiles_per_lane=2,
                    vector_col="vec", vector_size=3)

    def joint(rows):
        x = matrix([r[2] for r in rows], buckets)
        return np.hstack([x[:, :-1], [r[3] or [0.0] * 3 for r in rows], x[:, -1:]])
    known = [r for r in rows if r[1] is not None]
    w, losses = fit(joint(known), np.array([CLASSES.index(r[1]) for r in known]), 5, reg, rounds)
    got = np.zeros_like(w)
    for r in S.weights(model).where(f"feature <= {buckets + 3}").collect():
        got[r["feature"], CLASSES.index(r["label"])] = r["w"]
    assert np.abs(got - w).max() < 1e-9
    assert [loss for _, _, loss in model.losses] == pytest.approx(losses, abs=1e-9)
    z = joint(rows) @ w
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    probs = {r["doc_id"]: r["probs"] for r in S.probabilities(model, docs, vector_col="vec").collect()}
    assert len(probs) == len(rows) and max(np.abs(np.array(probs[i]) - p[i]).max() for i in range(len(rows))) < 1e-9
    with pytest.raises(Exception, match="a vector of 3 numbers, not 2"):
        S.train(docs, 1, buckets=buckets, vector_col="vec", vector_size=2)


def test_vectors_by_document(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], DOCS)
    parts = spark.createDataFrame([(1, 0, 0.5), (1, 2, -2.0)], "doc_id bigint, pos int, x double")
    got = {r["doc_id"]: r["vector"] for r in S.with_vectors(docs, parts, 3).collect()}
    assert got == {1: [0.5, 0.0, -2.0], 2: [0.0, 0.0, 0.0]}


def test_steps_reach_the_optimum():
    """The rounds end where the gradient is zero, so their fixed point is the regularised maximum-likelihood fit."""
    rows = [r for r in generated() if r[1] is not None]
    x, y = matrix([r[2] for r in rows], 32), np.array([CLASSES.index(r[1]) for r in rows])
    w, losses = fit(x, y, 5, 0.01, 4000)
    z = x @ w
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    p[np.arange(len(x)), y] -= 1
    slope = x.T @ p / len(x) + 0.01 * np.vstack([np.ones((32, 1)), [[0]]]) * w
    assert np.abs(slope).max() < 1e-6 and losses[0] == pytest.approx(math.log(5)) and losses[-1] < losses[0]


def test_restart(spark, tmp_path):
    """A job that stops after two rounds goes on from the second; no finished round is written again."""
    docs = spark.createDataFrame(generated(), DOCS)
    setting = dict(regs=[0.0, 0.1], buckets=16, span=8, width=3)
    first = S.Trainer(docs, path=str(tmp_path / "run"), **setting)
    first.round()
    first.round()
    before = {f.name: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    again = S.Trainer(docs, path=str(tmp_path / "run"), **setting)
    assert again.done == 2
    again.round()
    whole = S.train(docs, 3, **setting)
    assert all(f.stat().st_mtime_ns == before[f.name] for f in tmp_path.rglob("*.parquet") if f.name in before)

    def numbers(model):
        return {(r["model"], r["feature"], r["label"]): r["w"] for r in S.weights(model).collect()}
    a, b = numbers(again.model()), numbers(whole)
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-12


def test_822_classes(spark):
    """As many classes as the full code list, over the given documents: labels are learnt, the driver holds their names."""
    d = fx.v_labelled_docs(spark, SF_SMALL).select("doc_id", "text")
    n = d.count()
    codes = spark.range(822).select((F.col("id") + 5000).alias("doc_id"), F.format_string("%05d", "id").alias("true_label"),
                                    F.concat(F.lit("filler word code"), F.col("id")).alias("text"))
    docs = d.withColumn("true_label", F.format_string("%05d", F.col("doc_id") % 822)).unionByName(codes)
    model = S.train(docs, 2, regs=[0.0], buckets=1 << 10, span=256, width=64)
    assert len(model.classes) == 822 and model.layout.shards == 13
    assert model.losses[0][2] == pytest.approx(math.log(822)) and model.losses[1][2] < model.losses[0][2]
    assert model.coefs.agg(F.max(F.size("w"))).first()[0] == 256 * 64
    probs = S.probabilities(model, codes)
    assert probs.count() == 822 and n > 0
    assert probs.select(F.max(F.abs(F.aggregate("probs", F.lit(0.0), lambda a, b: a + b) - 1))).first()[0] < 1e-9


def test_distinct_tokens_are_hashed_once(spark):
    """m08_sharded_scores: buckets against hashlib, null and empty texts; no hash is taken per token."""
    texts = ["Å b b c_1", None, "", "b " * 500, "\U0001d7d8x e\u0301"]
    docs = spark.createDataFrame([(i if i else None, t, [0.5]) for i, t in enumerate(texts)], "doc_id long, text string, vector array<double>").coalesce(1)
    found = S.hashed(docs, 64)
    assert "md5" not in found._jdf.queryExecution().executedPlan().toString()
    want = L.tokenize(docs.fillna("", "text")).collect()
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64
    rows = found.collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["hashes"], r["vector"]) for r in rows) == sorted(
        (r["doc_id"] or 0, len(r["tokens"]), [bucket(w) for w in r["tokens"]], [0.5]) for r in want)


def test_plan_has_no_nested_loop(spark):
    model = S.train(spark.createDataFrame(generated(), DOCS), 1, regs=[0.0], buckets=16, span=8, width=3)
    plan = model.coefs._jdf.queryExecution().toString() + S.probabilities(
        model, spark.createDataFrame(generated(), DOCS))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_patience(spark):
    rows = generated()
    docs = spark.createDataFrame(rows, DOCS)
    state, best, table = S.train_with_dev(docs, docs.where("true_label is not null"), [0.0, 5.0], rounds=12, every=2, patience=1,
                                          buckets=32, span=16, width=3)
    checks = table.orderBy("round", "model").collect()
    by_round = {}
    for r in checks:
        by_round[r["round"]] = max(by_round.get(r["round"], 0), r["dev_macro_f"])
    rounds = sorted(by_round)
    tops = [max(by_round[k] for k in rounds[:i + 1]) for i in range(len(rounds))]
    assert all(b > a for a, b in zip(tops, tops[1:-1])) and (rounds[-1] == 12 or tops[-1] == tops[-2])
    assert by_round[state.rounds] == max(by_round.values())
    assert max(r["dev_macro_f"] for r in checks if r["round"] == state.rounds and r["model"] == best) == by_round[state.rounds]


def test_no_rows(spark):
    with pytest.raises(ValueError):
        S.train(spark.createDataFrame([(1, None, "x")], DOCS), 1, buckets=8)
