"""Embedding near-dedup against all pairs by brute force; components against union-find."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.llm import q_embeddings
from sectorlens.llm.components import components
from sectorlens.llm.embeddup import Scheme, group_links, hadamard, meets, near_duplicates, scheme_for, top_axes
from sectorlens.llm.registry import QUERIES
from tests.llm.common import SF, duck, same, spark_rows

COLS = ["vec_id", "n_links", "component_id", "kept"]


def frame(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], "mine") for i, e in rows],
                                 "vec_id bigint, embedding array<float>, kept string")


def groups(seed=3, dim=24):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for size, noise in ((60, 0.02), (25, 0.05), (10, 0.075), (8, 0.0), (1, 0)):
        center = rng.normal(size=dim)
        center /= np.linalg.norm(center)
        for _ in range(size):
            rows.append((at * 7 % 1009, ((center + rng.normal(size=dim) * noise) * rng.uniform(0.1, 9)).astype(np.float32)))
            at += 1
    return rows


def check(spark, rows, block):
    got = near_duplicates(frame(spark, rows), block=block).select(*COLS)
    pdf = pd.DataFrame([(i, None if e is None else list(map(float, e))) for i, e in rows], columns=["vec_id", "embedding"])
    same(spark_rows(got), duck(q_embeddings.BRUTE, embeddings=pdf))


def test_groups_in_chunks(spark):
    check(spark, groups(), 16)


def test_defined_cases(spark):
    rows = [(1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 0]), (5, [float("nan"), 1, 1]), (6, [float("inf"), 1, 1]),
            (7, [1, 2, 3]), (8, [2, 4, 6]), (9, [1, 2, 3]), (10, [1, 2, 3, 0]), (11, [-1, -2, -3]), (None, [1, 2, 3]), (12, [5])]
    got = {r["vec_id"]: tuple(r)[1:] for r in near_duplicates(frame(spark, rows)).select(*COLS).collect()}
    alone = {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 11, 12)}
    assert got == {**alone, 7: (2, 7, True), 8: (2, 7, False), 9: (2, 7, False), None: (0, None, True)}
    twice = near_duplicates(frame(spark, [(1, [1, 2]), (1, [1, 2])])).select(*COLS).collect()
    assert [tuple(r) for r in twice] == [(1, 1, 1, True)] * 2
    assert near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    for n, dim in ((500, 64), (10 ** 5, 64), (10 ** 7, 48)):
        scheme = scheme_for(dim, n)
        x, y = rng.normal(size=(2, 500, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(1, keepdims=True) * x
        y = 0.9 * x + np.sqrt(1 - 0.81) * y / np.linalg.norm(y, axis=1, keepdims=True)
        assert meets(scheme.codes(x), scheme.codes(y))[0].any(1).mean() > 0.97
    assert np.allclose(hadamard(np.eye(4)) @ hadamard(np.eye(4)).T, 4 * np.eye(4))
    assert [a.tolist() for a in top_axes(np.array([[0.1, -3, 2.0]]))] == [[3], [4]]
    assert Scheme(64, 2, 3).codes(x[:, :48] @ np.eye(48, 64))[0].shape == (3, 3)


def test_pairs_that_meet_by_probes_alone_are_counted_once():
    rng = np.random.default_rng(5)
    scheme = scheme_for(32, 20000)
    x, y = rng.normal(size=(2, 4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.901 * x + np.sqrt(1 - 0.901 ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = scheme.codes(x), scheme.codes(y)
    own = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1)
    probes = np.flatnonzero(~own & (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)))
    assert len(probes)
    ones, sides = np.ones(2, dtype=np.int64), np.zeros(2, dtype=np.int64)
    for p in [*probes[:3].tolist(), *np.flatnonzero(own)[:3].tolist()]:
        total, at = np.zeros(2, dtype=np.int64), np.array([10, 20])
        for t in range(scheme.tables):
            for bucket in sorted(set(a[p, t].tolist()) & set(b[p, t].tolist())):
                used, root, n = group_links(at, ones, np.stack([x[p], y[p]]), t, bucket, scheme, sides, 0.9)
                assert root.tolist() == [10, 10]
                total[used] += n
        assert total.tolist() == [1, 1]


def test_components_of_any_size(spark):
    rows = [(1, [1e300, 2e300, 0.0]), (2, [3e-300, 6e-300, 0.0]), (3, [1.0, 2.0, 0.0]), (4, [1.7e308, -1.7e308, 1.7e308])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r[0]: tuple(r)[1:] for r in near_duplicates(df).select(*COLS).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (0, 4, True)}


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, pairs):
    root = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in root:
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {tuple(r) for r in components(df, "a", "b").collect()} == set(root.items())


def test_whole_table(spark):
    same(spark_rows(QUERIES["op1_embedding_near_dedup"](spark, SF)), duck(q_embeddings.BRUTE))
