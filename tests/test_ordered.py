"""Restatement tests: Spark results vs plain-Python loops written from the
documented semantics, on random inputs including one hot key."""

import random

from pyspark.sql import functions as F

from sectorlens.operators.dataset import split_assignment
from sectorlens.operators.enrich import serial_code_quota
from sectorlens.operators.ordered import prefix_rank, top_k_per_key
from sectorlens.operators.sampling import budgeted_selection


def test_prefix_rank_hot_key(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}", i, rnd.randint(1, 9))
            for i in rnd.sample(range(100000), 5000)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r["k"], r["o"]): (r["rank"], r["before"]) for r in
           prefix_rank(df, ["k"], "o", value="v", before_col="before", n_buckets=16).collect()}
    exp = {}
    by = {}
    for k, o, v in rows:
        by.setdefault(k, []).append((o, v))
    for k, lst in by.items():
        run = 0
        for i, (o, v) in enumerate(sorted(lst)):
            exp[(k, o)] = (i + 1, run)
            run += v
    assert got == exp


def test_top_k_per_key(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("aab"), i) for i in rnd.sample(range(10000), 800)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = sorted((r["k"], r["o"], r["rank"]) for r in top_k_per_key(df, ["k"], ["o"], 7, "o", salts=8).collect())
    exp = []
    for k in "ab":
        for i, o in enumerate(sorted(o for kk, o in rows if kk == k)[:7]):
            exp.append((k, o, i + 1))
    assert got == sorted(exp)


def _split_loop(codes_of, with_url, has_data, pct, clean=False):
    """The reference's loop: companies with url grouped by primary code
    (``clean``: n counts only companies with data, no forced first dev)."""
    train, dev, test = pct
    groups = {}
    for cid in sorted(with_url):
        groups.setdefault(codes_of[cid][0], []).append(cid)
    stored, out = {}, {}
    for code, members in groups.items():
        n = len([c for c in members if c in has_data]) if clean else len(members)
        d = n * dev // 100
        t = n * test // 100
        for cid in members:
            if cid not in has_data:
                continue
            if (not clean and code not in stored) or stored.get(code, 0) < d:
                out[cid] = "dev"
                stored[code] = stored.get(code, 0) + 1
            elif stored.get(code, 0) < d + t:
                out[cid] = "test"
                stored[code] = stored.get(code, 0) + 1
            else:
                out[cid] = "train"
    return out


def test_split_matches_loop(spark):
    rnd = random.Random(11)
    comps, codes_of, with_url, has_data = [], {}, set(), set()
    for cid in range(1, 600):
        codes = [rnd.choice(["A", "A", "A", "B", "C"])] + ([rnd.choice("BC")] if rnd.random() < 0.3 else [])
        url = rnd.choice(["http://x", "", None, "  "]) if rnd.random() < 0.5 else "http://y"
        comps.append((cid, codes, url))
        codes_of[cid] = codes
        if url and url.strip():
            with_url.add(cid)
        if rnd.random() < 0.7:
            has_data.add(cid)
    c = spark.createDataFrame(comps, "company_id long, branch_codes array<string>, url string")
    e = spark.createDataFrame([(cid, "2024-01-01 00:00:00") for cid in has_data], "company_id long, run_ts string") \
        .withColumn("run_ts", F.col("run_ts").cast("timestamp"))
    for pct in [(70, 20, 10), (50, 25, 25), (100, 0, 0), (80, 5, 15)]:
        got = {r["company_id"]: r["split"] for r in split_assignment(c, e, pct).collect()}
        assert got == _split_loop(codes_of, with_url, has_data, pct)
        got = {r["company_id"]: r["split"] for r in split_assignment(c, e, pct, mode="clean").collect()}
        assert got == _split_loop(codes_of, with_url, has_data, pct, clean=True)


def test_budget_fold_matches_loop(spark):
    rnd = random.Random(7)
    rows = []
    for code in range(20):
        for m in rnd.sample(range(100), rnd.randint(1, 12)):
            rows.append((f"c{code}", f"{m:04d}", rnd.randint(0, 30)))
    df = spark.createDataFrame(rows, "sni_code string, municipality_code string, cnt long")
    got = sorted(tuple(r) for r in budgeted_selection(df, limit=50, seed=None).collect())
    exp = []
    for code in sorted({r[0] for r in rows}):
        total = 0
        for _, m, c in sorted((r for r in rows if r[0] == code), key=lambda r: r[1]):
            if total >= 50:
                break
            if c + total > 50:
                continue
            total += c
            exp.append((code, m, c))
    assert got == sorted(exp)


def test_budget_golden(spark):
    df = spark.createDataFrame([("x", "0001", 4), ("x", "0002", 8), ("x", "0003", 6), ("x", "0004", 1)],
                               "sni_code string, municipality_code string, cnt long")
    got = sorted(r["municipality_code"] for r in budgeted_selection(df, limit=10, seed=None).collect())
    assert got == ["0001", "0003"]


def test_serial_quota_matches_loop(spark):
    rnd = random.Random(13)
    comps = []
    for cid in range(1, 400):
        codes = rnd.sample(["10", "20", "30", "40"], rnd.randint(1, 3))
        comps.append((cid, f"n{cid}" if rnd.random() < 0.9 else "", codes, None if rnd.random() < 0.8 else "u"))
    c = spark.createDataFrame(comps, "company_id long, name string, branch_codes array<string>, url string")
    codes = spark.createDataFrame([(x,) for x in ["10", "20", "30", "40"]], "sni_code string")
    got = sorted(tuple(r) for r in serial_code_quota(c, codes, limit=25, salts=4).collect())
    taken, exp = set(), []
    for code in ["10", "20", "30", "40"]:
        n = 0
        for cid, name, bc, url in sorted(comps):
            if n >= 25:
                break
            if code in bc and url is None and cid not in taken and name:
                taken.add(cid)
                exp.append((cid, code))
                n += 1
    assert got == sorted(exp)


def test_assemble_documents_cut(spark):
    """Keys below and above the cut, including one key with most pages."""
    from sectorlens.operators.dataset import assemble_documents
    rnd = random.Random(17)
    rows = []
    for k in range(12):
        n = 400 if k == 0 else rnd.randint(1, 8)
        for s in rnd.sample(range(10000), n):
            rows.append((k, s, "x" * rnd.randint(0, 30)))
    df = spark.createDataFrame(rows, "k long, seq long, data string")
    got = {r["k"]: r["text"] for r in assemble_documents(df, ["k"], max_chars=200).collect()}
    exp = {}
    for k in {r[0] for r in rows}:
        t = "".join(" " + d for _, _, d in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]))
        exp[k] = t[:200]
    assert got == exp


def test_prefix_rank_null_keys(spark):
    rows = [(None, 3), (None, 1), ("a", 2), ("a", 5), (None, 2)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = sorted((r["k"] or "", r["o"], r["rank"]) for r in prefix_rank(df, ["k"], "o", n_buckets=4).collect())
    assert got == [("", 1, 1), ("", 2, 2), ("", 3, 3), ("a", 2, 1), ("a", 5, 2)]


def test_serial_quota_rounds_write_only_the_rejected(spark, monkeypatch):
    """Later rounds store who was rejected and has a code left, never all proposals again."""
    from sectorlens.operators import enrich
    written = []
    real = enrich.staged

    def counting(df, name):
        out = real(df, name)
        written.append((name, out.count()))
        return out
    monkeypatch.setattr(enrich, "staged", counting)
    rows = [(i, f"n{i}", ["10", "20", "30"] if i % 3 == 0 else ["20"] if i % 3 == 1 else ["30", "10"], None) for i in range(600)]
    rows.append((None, "nobody", ["10"], None))
    c = spark.createDataFrame(rows, "company_id long, name string, branch_codes array<string>, url string")
    codes = spark.createDataFrame([(x,) for x in ["10", "20", "30"]], "sni_code string")
    got = sorted(tuple(r) for r in serial_code_quota(c, codes, limit=50, salts=4).collect())
    taken, exp = set(), []
    for code in ["10", "20", "30"]:
        mine = [r[0] for r in rows if r[0] is not None and code in r[2] and r[0] not in taken][:50]
        taken |= set(mine)
        exp += [(m, code) for m in mine]
    assert got == sorted(exp)
    asked = [n for name, n in written if name == "quota-asking"]
    assert asked[0] == 600 and asked[-1] == 0 and asked == sorted(asked, reverse=True)
    # those above a full code's bound are not asked to try it
    assert max(asked[1:]) < 400
    assert all(n <= 150 for name, n in written if name == "quota-held")
