"""The pipeline against its stages' brute-force versions, chained."""

import corpus_pipeline as P
from tests.llm.common import docs
from tests.llm.test_mixing import brute as mix
from tests.llm.test_neardup import brute as near
from tests.llm.test_secrets import brute as scan
from sectorlens.llm.words import alnum_words

SF = "/root/testdata/sf0.01"


def windows(text):
    w = alnum_words((text or "").encode())
    n = min(10, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def masked(text):
    at, out = 0, []
    for kind, s, e in sorted((x.split(":") for x in scan(text)[4].split(",") if x), key=lambda x: (int(x[1]), int(x[2]))):
        s, e = int(s), int(e)
        if s >= at:
            out += [text[at:s], "[REDACTED]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def test_whole_table(spark):
    rows = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    step = spark.read.parquet(f"{SF}/documents.parquet")
    columns = step.columns
    kept = {}
    for name, stage in P.STAGES[:-1]:
        step = P.stored(stage(spark, step, SF), name)
        assert step.columns == columns
        kept[name] = {r["doc_id"]: r.asDict() for r in step.collect()}
    assert set(kept["language_id"]) == set(rows)  # every document has a clear language
    one = near({i: r["text"] for i, r in kept["language_id"].items()})
    assert set(kept["minhash_near_dedup"]) == {i for i, (_, _, k) in one.items() if k}
    bad = [windows(r[0]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    short = {len(w) for ws in bad for w in ws}

    def leaks(text):
        w = alnum_words((text or "").encode())
        mine = {tuple(w[i:i + n]) for n in short for i in range(len(w) - n + 1)}
        return any(mine & ws for ws in bad)
    clean = {i for i, r in kept["minhash_near_dedup"].items() if not leaks(r["text"])}
    assert set(kept["benchmark_decontamination"]) == clean
    for i in clean:
        r = kept["secret_scans"][i]
        assert r["text"] == masked(rows[i]["text"]) and r["n_chars"] == (
            rows[i]["n_chars"] if r["text"] == rows[i]["text"] else len(r["text"]))
    want = mix([tuple(kept["secret_scans"][i][c] for c in ("doc_id", "text", "source")) for i in sorted(clean)])
    got = {}
    for r in P.run(spark, SF).collect():
        got.setdefault(r["doc_id"], []).append(r["copy"])
    assert {i: sorted(c) for i, c in got.items()} == {w[0]: list(range(1, w[4] + 1)) for w in want if w[4]}


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, "", None, None), (2, "the cat sat on a mat today ok", "en", None), (2, "the cat sat on a mat today ok", "en", None),
            (3, "password=abcdef123 the dog ran", "en", "s")]
    df = docs(spark, rows).selectExpr("*", "1 as size", "'x' as spans", "2 as row", "3 as id", "4 as c0", "5 as lang_pred")
    for stage in (P.near_dedup, P.secret_scan):
        assert stage(spark, df, SF).columns == df.columns
    for _, stage in P.STAGES:
        df = P.stored(stage(spark, df, SF), "odd")
    out = df.collect()
    assert {r["doc_id"] for r in out} <= {2, 3} and all("password" not in r["text"] for r in out)
