"""Licence scans: base phrases against a plain scan, matching statistics against brute force, chains by example."""

from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.llm import q_licences  # noqa: F401
from sectorlens.llm.licences import COVER, MAX_GAP, MIN_MATCH, PHRASES, TEMPLATES, Automaton, Scanner, scan_licences
from sectorlens.llm.registry import QUERIES
from sectorlens.llm.words import alnum_words
from tests.llm.common import docs

SF = "/root/testdata/sf0.01"


def brute(text):
    w = alnum_words((text or "").encode())
    at = [(i, label) for p, label in PHRASES for q in [p.encode().split()] for i in range(len(w)) if w[i:i + len(q)] == q]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=9), min_size=1, max_size=4),
       st.lists(st.integers(0, 4), max_size=25))
def test_matching_statistics(sequences, text):
    automaton = Automaton(sequences)
    for i, (length, state) in enumerate(automaton.statistics(text)):
        known = [n for n in range(i + 2) if any(s[e - n:e] == text[i + 1 - n:i + 1] for s in sequences for e in range(n, len(s) + 1))]
        assert length == max(known)
        want = {(k, e) for k, s in enumerate(sequences) for e in range(length, len(s) + 1) if s[e - length:e] == text[i + 1 - length:i + 1]}
        assert not length or automaton.ends[state] == want


def test_cases(spark):
    texts = [None, "", "MIT license, mit-license! The MIT  License", "general public license general public", "apache É license",
             "Licensed under CC BY-NC 4.0.", "x Licensed under the Apache License, Version 2.0. y", "the of in under " * 20000 + "mit license",
             "Permission is hereby granted, free of charge, to anyone, any person obtaining a copy of this software and associated"
             " documentation files", "licensed under cc by sa 4 0 licensed under cc by 4 0", "license " * 500, "mit apache general"]
    got = {r["doc_id"]: r for r in scan_licences(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute(t), t
    assert [got[i]["labels"] for i in (2, 5, 6, 9)] == ["mit", "cc-by-nc-4.0", "apache,apache-2.0", "cc-by-4.0,cc-by-sa-4.0"]
    assert got[5]["score"] == got[6]["score"] == 1.0 and got[0]["score"] == got[11]["score"] == 0.0
    assert [(s["start"], s["end"]) for s in got[6]["spans"]] == [(1, 9)]
    assert got[8]["labels"] == "mit-notice" and 0.9 <= got[8]["score"] < 1
    df = docs(spark, texts).selectExpr("*", "'mine' as labels")
    assert scan_licences(df, keep=df.columns).where("labels = 'mine'").count() == 0
    assert scan_licences(df.limit(0)).count() == 0


def test_whole_table(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_licences"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        g = got[r[0]]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == brute(r[1])
        assert set(filter(None, g["base_labels"].split(","))) <= set(g["labels"].split(","))
    assert any("cc-by-nc-4.0" in g["labels"] for g in got.values())


def test_scanner_is_small():
    assert len(Scanner().automaton.size) < 1000


def test_verbatim_after_fragments():
    """Every template verbatim, each time after one of its own fragments, is a full span."""
    scanner = Scanner()
    for label, template in TEMPLATES:
        w = template.encode().split()
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for between in ([b"or"], [b"zz"] * 3):
                    spans, best = scanner.row([*w[i:j], *between, *w])[-1], scanner.row([*w[i:j], *between, *w])[-2]
                    at = j - i + len(between)
                    assert {"label": label, "start": at, "end": at + len(w), "cover": 1.0} in spans and best == 1.0
    row = scanner.row(alnum_words(b"licensed under the GNU General Public License, that is, licensed under the GNU General Public License version 3"))
    assert "gpl-3.0" in row[5]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), min_size=3, max_size=8), min_size=1, max_size=3),
       st.lists(st.sampled_from("abcdx"), max_size=16))
def test_best_cover_by_brute_force(templates, text):
    """The best cover against all chains of all maximal stretches of each template."""
    best = 0.0
    for t in templates:
        m = [(i, j, k) for i in range(len(text)) for j in range(len(t)) for k in [next(
            (k for k in range(len(t) + 1) if i + k >= len(text) or j + k >= len(t) or text[i + k] != t[j + k]), 0)]
            if k >= MIN_MATCH and not (i and j and text[i - 1] == t[j - 1])]

        def extend(first, end, stop, matched):
            nonlocal best
            best = max(best, matched / max(len(t), end - first))
            for i, j, k in m:
                cut = max(end - i, stop - j, 0)
                if j + k > stop and i - end <= MAX_GAP and cut < k and i > first:
                    extend(first, i + k, j + k, matched + k - cut)
        for i, j, k in m:
            extend(i, i + k, j + k, k)
    scanner = Scanner([(str(n), " ".join(t)) for n, t in enumerate(templates)], ())
    row = scanner.row([c.encode() for c in text])
    assert abs(row[-2] - best) < 1e-12 and (best >= COVER) == bool(row[-1])
