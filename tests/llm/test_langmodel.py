"""Elias-Fano against sorted arrays; LM scores against a plain restatement with dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.llm import q_langmodel  # noqa: F401
from sectorlens.llm.eliasfano import EliasFano
from sectorlens.llm.langmodel import LAMBDA, probability, quantised, score_documents
from sectorlens.llm.registry import QUERIES
from tests.llm.common import docs


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1) | st.integers(0, 300), max_size=60), st.lists(st.integers(0, 2 ** 64 - 1) | st.integers(0, 310)),
       st.booleans())
def test_elias_fano(values, asked, small):
    values = sorted(v % 301 for v in values) if small else sorted(values)
    universe = 301 if small else 1 << 64
    asked = [a % universe for a in asked] + values
    data = b"\7" * 8 + EliasFano.encode(np.array(values, dtype=np.uint64), universe)
    seq = EliasFano(data, 8)
    assert seq.end == len(data) and len(data) % 8 == 0
    assert seq.get(np.arange(len(values))).tolist() == values
    place, equal = seq.successor(np.array(asked, dtype=np.uint64))
    for a, p, e in zip(asked, place.tolist(), equal.tolist()):
        assert p == sum(v < a for v in values) and e == (a in values)


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 40, size=100_000))
    assert len(EliasFano.encode(values, 1 << 40)) * 8 / len(values) < 40 - math.log2(100_000) + 4.5


def brute(rows):
    texts = [(i, (t or "").encode().lower().split()) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    uni, bi = Counter(), Counter()
    for (_, w), h in zip(texts, held):
        if not h:
            uni.update([*w, None])
            bi.update(zip(["start", *w], [*w, None]))
    n, v = sum(uni.values()), len(uni)
    context = uni | Counter()
    context["start"] = sum(not h for h in held)
    out = []
    for (i, w), h in zip(texts, held):
        p0 = [(uni[t] + 0.5) / (n + 0.5 * (v + 1)) for t in [*w, None]]
        p = []
        for prev, t, p1 in zip(["start", *w], [*w, None], p0):
            if context[prev]:
                share = LAMBDA * bi[prev, t] / context[prev]
                q = float(probability(quantised(np.array([share])))[0]) if share else 0.0
                p.append(q + (1 - LAMBDA) * p1)
            else:
                p.append(p1)
        out.append((i, h, len(w) + 1, sum(uni[t] > 0 for t in [*w, None]), n, sum(map(math.log10, p0)), sum(map(math.log10, p))))
    return out


def check(got, want):
    key = lambda r: [str(x) for x in r[:4]] + [round(x, 6) for x in r[5:]]
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-9)


def test_cases(spark):
    rows = [(i, t) for i, t in enumerate([None, "", "a", "A b a\tb", "b a c", "é É é", "z " * 3000, "new words here", "a b a b", "a b", " "] * 2)]
    rows += [(None, "a b"), (3, "A b a\tb")]
    check(score_documents(docs(spark, rows), 50).collect(), brute(rows))
    assert score_documents(docs(spark, rows).limit(0)).count() == 0
    only = [(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    check(score_documents(docs(spark, only)).collect(), brute(only))


@pytest.mark.parametrize("shard_tokens", [1 << 20, 20_000])
def test_whole_table(spark, shard_tokens):
    sf = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in df.collect()])
    check(score_documents(df, shard_tokens).collect(), want)
    if shard_tokens == 1 << 20:
        check(QUERIES["op9_lm_scoring"](spark, sf).collect(), want)
        assert sum(w[6] for w in want if w[1]) > sum(w[5] for w in want if w[1])  # better than unigrams on held-out texts
