"""Near-dedup against all pairs of full shingle sets."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from sectorlens.llm import q_neardup  # noqa: F401
from sectorlens.llm.neardup import SIDE, Shingler, classes, joined_parts, keep_one_of_each, near_duplicates, sign, signatures
from sectorlens.llm.registry import QUERIES
from sectorlens.llm.storage import stored
from tests.llm.common import docs

COLS = ["doc_id", "n_shingles", "component_id", "kept"]


def shingles(text):
    w = (text or "").encode().lower().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if k else frozenset()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if 0.75 <= len(a) / len(b) <= 4 / 3 and find(i) != find(j) and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.select(*COLS).collect()}


def families(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size, edits in ((40, 2), (30, 5), (12, 9), (5, 0), (1, 0)):
        base = rng.choices(vocabulary, k=90)
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


def test_families(spark):
    texts = families()
    assert rows(near_duplicates(docs(spark, texts))) == brute(dict(enumerate(texts)))


def test_small_blocks(spark):
    texts = families(6)
    slim = docs(spark, texts).selectExpr("doc_id as id", "text")
    found = {r[0]: r[1] for r in classes(stored(sign(slim), "signatures"), slim, block=7).collect()}
    assert {i: (found.get(i, i)) for i in range(len(texts))} == {i: b[1] for i, b in brute(dict(enumerate(texts))).items()}


def test_defined_cases(spark):
    texts = [None, "", " \t", "one two", "ONE  two", "one two three", "x " * 200000, "x " * 5, "x " * 4, "É a b c d", "é a b c d",
             (20, "a b c d e f"), (20, "a b c d e f"), (21, "a b c d e f"), (22, "q r s"), (22, "t u v"), (23, "t u v"),
             (None, "one two")]
    got = [tuple(r) for r in near_duplicates(docs(spark, texts)).select(*COLS).collect()]
    key = lambda r: [str(x) for x in r]
    want = [(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False), (5, 1, 5, True), (6, 1, 6, True),
            (7, 1, 6, False), (8, 1, 8, True), (9, 1, 9, True), (10, 1, 10, True), (20, 2, 20, True), (20, 2, 20, True),
            (21, 2, 20, False), (22, 1, 22, True), (22, 1, 22, True), (23, 1, 22, False), (None, 1, None, True)]
    assert sorted(got, key=key) == sorted(want, key=key)
    df = docs(spark, texts).selectExpr("*", "'mine' as n_shingles", "1 as id", "2 as row")
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [0, 1, 2, 3, 5, 6, 8, 9, 10, 20, 22, None]))
    assert near_duplicates(df.limit(0)).count() == 0 and keep_one_of_each(df.limit(0)).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert rows(QUERIES["op5_minhash_near_dedup"](spark, sf)) == brute(texts)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(300):
        x = rng.integers(0, 1 << 62, size=700, dtype=np.uint64)
        a, b = signatures(np.sort(x[:600])), signatures(np.sort(x[100:]))  # 500 of 700: below the threshold still
        met += (a[:SIDE] == b[:SIDE]).any() and (a[SIDE:] == b[SIDE:]).any()
    assert met / 300 > 0.97


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.frozensets(st.integers(0, 7), min_size=1), st.integers(0, 3), st.integers(0, 1)), min_size=1, max_size=8))
def test_joined_parts(rows):
    got = joined_parts(np.array([p for _, p, _ in rows]), np.array([s for *_, s in rows]),
                       np.array([x for v, *_ in rows for x in sorted(v)]), np.array([len(v) for v, *_ in rows]), 75)
    want = {(min(p, q), max(p, q)) for v, p, s in rows for w, q, _ in rows if s == 0 and p != q and 4 * len(v & w) >= 3 * len(v | w)}
    assert {tuple(r) for r in got.tolist()} == want


def test_shingler_forgets_words():
    s = Shingler()
    a = s.shingles(b"a b c d e f")
    s.known = {b"%d" % i: 0 for i in range((1 << 20) + 1)}
    assert (s.shingles(b"A b c d e f") == a).all() and len(s.known) == 6
