"""Language ID: held-out accuracy, Viterbi against all label sequences, and defined cases."""

import itertools
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.llm import q_langid  # noqa: F401
from sectorlens.llm.langid import SWITCH_PENALTY, fit, identify, keep_identified, viterbi, words_of
from sectorlens.llm.registry import QUERIES
from tests.llm.common import docs

SF = "/root/testdata/sf0.01"
EN, RU, EL = "the quick brown fox jumps over the lazy dog", "съешь же ещё этих мягких французских булок", "ξεσκεπάζω την ψυχοφθόρα βδελυγμία"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=5), min_size=1, max_size=4), st.integers(0, 9))
def test_viterbi(texts, seed):
    scores = np.random.default_rng(seed).normal(size=(7, 3)).round(3) * 3
    sizes = np.array([len(t) for t in texts])
    ids = np.array([w for t in texts for w in t], dtype=int)
    labels = viterbi(scores, ids, sizes, 1.3).tolist()

    def total(text, path):
        return sum(scores[w, p] for w, p in zip(text, path)) - 1.3 * sum(a != b for a, b in zip(path, path[1:]))
    for text in texts:
        mine, labels = labels[:len(text)], labels[len(text):]
        best = max(total(text, p) for p in itertools.product(range(3), repeat=len(text)))
        assert abs(total(text, mine) - best) < 1e-9


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, SF).collect()}
    lang = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i in got if got[i]["held_out"]]
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def model_docs(spark):
    rows = [(i, t, la, "s") for i, (t, la) in enumerate([(EN, "en"), (RU, "ru"), (EL, "el")] * 8)]
    return docs(spark, rows + [(90, EN, None, None), (None, RU, "ru", None), (91, None, "xx", "s"), (92, "...", "xx", "s")])


def test_cases(spark):
    model = fit(model_docs(spark))
    assert model.langs == ["el", "en", "ru"]
    texts = [None, "", "12 %% ½ ²", "日本語", EN + " " + RU, "The Dog", RU.upper(), EN + " " + "x" * 50000, EN + " 漢字", EN, EN]
    got = [r for r in identify(docs(spark, texts), model).orderBy("doc_id").collect()]
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "el", "ru", "en", "ru", "en", "en", "en", "en"]
    assert [r["score"] for r in got[:4]] == [0, 0, 0, 0] and got[9] == got[9]
    assert [(s["lang"], s["start"], s["end"]) for s in got[4]["spans"]] == [("en", 0, 9), ("ru", 9, 16)]
    assert len(words_of(b"one " * 300000)) == 300000 and SWITCH_PENALTY > 0
    df = docs(spark, texts).selectExpr("*", "'mine' as lang_pred")
    assert identify(df, model, keep=df.columns).where("lang_pred = 'mine'").count() == 0


def test_filter_and_empty(spark):
    df = model_docs(spark).selectExpr("*", "1 as score", "2 as row")
    kept = keep_identified(df)
    assert kept.columns == df.columns and kept.count() == 26
    assert keep_identified(df.limit(0)).count() == 0
    none = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in identify(none, fit(none)).collect()} == {"und"}


def test_mixed_documents_stay(spark):
    """No language above half, but all letters labelled: kept; mostly unknown letters: dropped."""
    mixed, foreign = f"{EN} {RU} {EL}", EN + " " + "漢" * 200
    df = model_docs(spark).unionByName(docs(spark, [(100, mixed, None, None), (101, foreign, None, None)]))
    found = {r["doc_id"]: r for r in identify(df, fit(df)).where("doc_id >= 100").collect()}
    assert found[100]["score"] < 0.5 and found[100]["known"] == 1.0 and {s["lang"] for s in found[100]["spans"]} == {"en", "ru", "el"}
    assert found[101]["known"] < 0.5
    assert {r["doc_id"] for r in keep_identified(df).where("doc_id >= 100").collect()} == {100}


def test_junk_goes(spark):
    """Letters of a known script that form no words of a language are labelled but not known; the given documents stay."""
    rng = np.random.default_rng(3)
    junk = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(200)) for _ in range(20)]
    junk += ["asdf qwer hjkl zxcv " * 40]
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    df = real.unionByName(docs(spark, [(10**9 + i, t, None, None) for i, t in enumerate(junk)]))
    kept = {r["doc_id"] for r in keep_identified(df).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in real.select("doc_id").collect()}


def test_malformed_text(spark):
    model = fit(model_docs(spark))
    raw = spark.range(1).selectExpr("id AS doc_id", "cast(X'68ff69' AS string) AS text", "'en' AS lang", "'s' AS source")
    assert words_of(b"h\xffi") == ["h", "i"]
    row = identify(raw, model).collect()[0]
    assert row["lang_pred"] in ("en", "el", "ru") and row["spans"][0]["end"] == 2
    assert fit(raw).langs in ([], ["en"])
