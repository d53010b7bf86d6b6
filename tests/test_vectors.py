"""M04 by factorisation: counts against a loop, vectors against NumPy's dense eigenvectors."""

import random
from collections import Counter

import numpy as np

from sectorlens.operators import learn as L
from sectorlens.operators import vectors as W
from sectorlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


def dense(matrix):
    rows = [tuple(r) for r in matrix.collect()]
    words = sorted({r[0] for r in rows})
    at = {w: i for i, w in enumerate(words)}
    m = np.zeros((len(words), len(words)))
    for a, b, v in rows:
        m[at[a], at[b]] = v
    return words, m


def best_factors(m, size):
    values, axes = np.linalg.eigh(m)
    top = np.argsort(-np.abs(values))[:size]
    return values[top], axes[:, top] * np.sqrt(np.abs(values[top]))


def test_counts_match_a_loop(spark):
    rnd = random.Random(5)
    texts = [[rnd.choice("abcdefg") for _ in range(n)] for n in (0, 1, 2, 3, 50, 301)] + [None, ["a", None, "b"], ["x"] * 30]
    df = spark.createDataFrame([(t,) for t in texts], "tokens array<string>")
    exp = Counter()
    for t in texts:
        for i in range(len(t or [])):
            for d in (1, 2, 3):
                if i + d < len(t) and t[i] is not None and t[i + d] is not None:
                    exp[t[i], t[i + d]] += 1
                    exp[t[i + d], t[i]] += 1
    for piece in (7, 4096):  # texts longer than a piece count the same
        got = {(r[0], r[1]): r[2] for r in W.mirrored(W.pair_counts(df, window=3, piece=piece), "n").collect()}
        assert got == dict(exp)
    often = {w for w, n in Counter(w for t in texts for w in t or []).items() if n >= 60}
    assert 0 < len(often) < 8
    rare = {(r[0], r[1]) for r in W.mirrored(W.pair_counts(df, window=3, min_count=60), "n").collect()}
    assert rare == {k for k in exp if set(k) <= often}


def test_planted_topics_are_neighbours(spark):
    rnd = random.Random(9)
    topics = [[f"t{t}w{i}" for i in range(12)] for t in range(4)]
    df = spark.createDataFrame([([rnd.choice(rnd.choice([topics[i % 4]] * 9 + topics)) if rnd.random() < 0.1 else rnd.choice(topics[i % 4])
                                  for _ in range(60)],) for i in range(200)], "tokens array<string>")
    vectors, values = W.factorised(W.ppmi(W.pair_counts(df)), size=4, rounds=4)
    assert len(values) == 4 and (np.diff(np.abs(values)) <= 1e-9).all()
    near = W.nearest_words(vectors, ["t0w0", "t3w5", "unknown"], n=11).collect()
    assert {r["query"] for r in near} == {"t0w0", "t3w5"} and len(near) == 22
    assert all(r["word"][:2] == r["query"][:2] for r in near)
    assert sorted(r["rank"] for r in near if r["query"] == "t0w0") == list(range(1, 12))


def test_whole_table_against_dense_factors(spark):
    d = L.tokenize(fx.v_labelled_docs(spark, SF_SMALL))
    matrix = W.staged(W.ppmi(W.pair_counts(d, min_count=5)), "test-matrix")
    words, m = dense(W.mirrored(matrix, "value"))
    assert len(words) > 100 and np.allclose(m, m.T)
    size = 4  # the fifth eigenvalue is far smaller, so NumPy's space is the only right one
    values, exact = best_factors(m, size)
    vectors, got = W.factorised(matrix, size=size, rounds=6, oversample=12)
    assert np.allclose(np.abs(got), np.abs(values), rtol=1e-2)
    mine = {r[0]: r[1] for r in vectors.collect()}
    assert sorted(mine) == words
    v = np.array([mine[w] for w in words])
    best = np.linalg.norm(m - (exact * np.sign(values)) @ exact.T)
    assert np.linalg.norm(m - (v * np.sign(got)) @ v.T) <= 1.001 * best
    lengths = np.linalg.norm(exact, axis=1)
    held = np.flatnonzero(lengths >= 0.1)
    unit = exact[held] / lengths[held, None]
    asked = held[::max(1, len(held) // 20)].tolist()
    near = {}
    for r in W.nearest_words(vectors, [words[i] for i in asked], n=5, least=0.1).collect():
        near.setdefault(r["query"], []).append(words.index(r["word"]))
    good = every = 0
    for i in asked:
        close = dict(zip(held.tolist(), unit @ (exact[i] / lengths[i])))
        del close[i]
        bar = sorted(close.values())[-5] - 0.01  # as near as NumPy's fifth; ties may come in any order
        every += 5
        good += sum(close.get(j, -2) >= bar for j in near[words[i]])
    assert every >= 50 and good >= 0.95 * every


def test_no_pairs(spark):
    empty = spark.createDataFrame([(["a"],), (None,)], "tokens array<string>")
    vectors, values = W.factorised(W.ppmi(W.pair_counts(empty)))
    assert vectors.count() == 0 and len(values) == 0
    pair = spark.createDataFrame([(["a", "b"],)], "tokens array<string>")
    vectors, values = W.factorised(W.ppmi(W.pair_counts(pair)), size=4)
    assert np.allclose(np.abs(values), [np.log(2)] * 2) and {r[0] for r in vectors.collect()} == {"a", "b"}


def test_pairs_are_shuffled_as_blocks(spark, monkeypatch):
    """m04_ppmi: counts and sums over many chunks against a loop; no pair is a row of its own in a shuffle."""
    rnd = random.Random(8)
    texts = [[rnd.choice(["å", "b", "c c", None, "d" * 40, "\n", ""]) for _ in range(rnd.randrange(40))] for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(3)
    exp = Counter()
    for t in texts:
        for i in range(len(t)):
            for j in (i + 1, i + 2):
                if j < len(t) and t[i] is not None and t[j] is not None:
                    exp[t[i], t[j]] += 1
                    exp[t[j], t[i]] += 1
    sums = Counter()
    for (w, _), n in exp.items():
        sums[w] += n
    monkeypatch.setattr(W, "CHUNK", 50)
    for bucket in (10, 1 << 23):
        monkeypatch.setattr(W, "BUCKET", bucket)
        counts = W.pair_counts(df)
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(a#" not in plan and "hashpartitioning(bucket#" in plan
        rows = counts.collect()
        assert {(r["a"], r["b"]): r["n"] for r in rows} == {k: n for k, n in exp.items() if k[0] <= k[1]}
        assert len(rows) == len({(r["a"], r["b"]) for r in rows})
        assert all((r["na"], r["nb"], r["every"]) == (sums[r["a"]], sums[r["b"]], sum(sums.values())) for r in rows)


def test_matrix_is_multiplied_by_blocks(spark, monkeypatch):
    """m04_factorised_vectors: products over many blocks against NumPy; no entry is joined as a row of its own."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    rows = [(a, b, rnd.random()) for a in words for b in words if a <= b and rnd.random() < 0.3]
    rows += [("all", w, 1.0) for w in words]
    matrix = spark.createDataFrame(rows, "a string, b string, value double").repartition(2)
    monkeypatch.setattr(W, "BLOCK", 40)
    blocks = W.staged(W.matrix_blocks(matrix), "test-blocks")
    assert blocks.count() >= len(rows) / 41
    names, m = dense(W.mirrored(matrix, "value"))
    given = {w: [rnd.random(), rnd.random()] for w in names[1:]}
    found = W.times(blocks, spark.createDataFrame(list(given.items()), "word string, vector array<double>"), 2)
    assert "Generate inline" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r[0]: r[1] for r in found.collect()}
    assert np.allclose([got[w] for w in names], m @ np.array([given.get(w, [0, 0]) for w in names]))


def test_means_meet_words_not_terms(spark):
    """m04_factorised_vectors: repeated rows of a token add up; unknown tokens, rows without known ones, null vectors."""
    docs = spark.createDataFrame([(1, ["a", "b", "a", "x"], 4), (2, ["x"], 1), (1, ["b"], 1), (None, ["a"], 1)], "doc_id long, tokens array<string>, n_tokens long")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [0.5, 0.0]), ("b", [10.0, 0.0]), ("x", None), (None, [9.0, 9.0])],
                                    "token string, vector array<double>")
    means = L.mean_long_vectors(docs, vectors)
    assert "tf" not in means._jdf.queryExecution().executedPlan().toString().split("FlatMapCoGroups")[0]
    assert {(r[0], r[1]): r[2] for r in means.collect()} == {(1, 0): 23 / 4, (1, 1): 1.0, (None, 0): 1.5, (None, 1): 2.0}


def test_terms_are_counted_without_a_shuffle(spark):
    """m04_mean_of_given_vectors: term counts against a loop; null tokens, empty and missing lists, rows of one id."""
    rnd = random.Random(3)
    rows = [(rnd.randrange(6) if i % 7 else None, [rnd.choice(["a", "b", "å", None, "long" * 9]) for _ in range(n)] if n is not None else None)
            for i, n in enumerate([0, 1, 40, None, 3, 25, 2, 300, 0, 7])]
    df = spark.createDataFrame([(i, t, len(t or [])) for i, t in rows], "doc_id long, tokens array<string>, n_tokens long").coalesce(1)
    want = Counter((i, len(t), w, n) for i, t in rows if t for w, n in Counter(x for x in t if x is not None).items())
    for most in (1, 30, 1 << 18):
        found = L.term_counts(df, most=most)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().replace("Coalesce", "")
        assert Counter(tuple(r) for r in found.collect()) == want
    sums, sizes = Counter(), {}
    for i, t in rows:
        for w in t or []:
            sums[i] += len(w) if w else 0
            sizes[i] = max(sizes.get(i, 0), len(t))
    vectors = spark.createDataFrame([(w, [float(len(w))]) for w in ("a", "b", "å", "long" * 9)], "token string, vector array<double>")
    mean = {r[0]: r[2] for r in L.mean_vectors(df, vectors).collect()}
    assert mean == {i: sums[i] / sizes[i] for i in mean} and set(mean) == {i for i in sums if sums[i]}
