"""E19 by published suffix rules: the list's own cases and odd hosts."""

import pytest

from sectorlens.functions import urls as U

LINES = ["// ===BEGIN===", "", "  ", "com", "uk\t// note", "co.uk", "*.ck", "!www.ck", "jp", "ac.jp", "kyoto.jp", "ide.kyoto.jp", "*.kobe.jp",
         "!city.kobe.jp", "cn", "公司.cn", "中国", "US", "k12.ak.us"]
# host, suffix, label before it ("" where there is none)
CASES = [
    ("example.com", "com", "example"), ("b.example.com", "com", "example"), ("com", "", "com"), ("example.example", "example", "example"),
    ("b.c.ck", "c.ck", "b"), ("a.b.c.ck", "c.ck", "b"), ("c.ck", "c.ck", ""), ("www.ck", "ck", "www"), ("www.www.ck", "ck", "www"),
    ("test.jp", "jp", "test"), ("test.ac.jp", "ac.jp", "test"), ("ide.kyoto.jp", "ide.kyoto.jp", ""), ("b.ide.kyoto.jp", "ide.kyoto.jp", "b"),
    ("b.c.kobe.jp", "c.kobe.jp", "b"), ("c.kobe.jp", "c.kobe.jp", ""), ("city.kobe.jp", "kobe.jp", "city"), ("www.city.kobe.jp", "kobe.jp", "city"),
    ("食狮.公司.cn", "公司.cn", "食狮"), ("www.食狮.公司.cn", "公司.cn", "食狮"), ("xn--85x722f.xn--55qx5d.cn", "xn--55qx5d.cn", "xn--85x722f"),
    ("食狮.xn--fiqs8s", "xn--fiqs8s", "食狮"), ("test.k12.ak.us", "k12.ak.us", "test"), ("EXAMPLE.Co.Uk", "co.uk", "example"),
    ("10.0.0.1", "", "10.0.0.1"), ("localhost", "", "localhost"), ("a..com", "com", ""),
]


@pytest.fixture(scope="module")
def rules(spark):
    return U.suffix_rules(spark.createDataFrame([(x,) for x in LINES], "line string"))


def test_rules(rules):
    got = {r["rule"] for r in rules.collect()}
    assert got == {"com", "uk", "co.uk", "*.ck", "!www.ck", "jp", "ac.jp", "kyoto.jp", "ide.kyoto.jp", "*.kobe.jp", "!city.kobe.jp", "cn",
                   "xn--55qx5d.cn", "xn--fiqs8s", "us", "k12.ak.us"}


def test_cases(spark, rules):
    rows = [(i, f"https://u@{h}:81/p?q") for i, (h, _, _) in enumerate(CASES)] + [(100, None), (101, ""), (102, "http://")]
    df = spark.createDataFrame(rows * 2, "id int, url string")
    got = U.with_public_suffix(df, rules, prefix="x_").collect()
    assert len(got) == 2 * len(rows)
    by_id = {r["id"]: (r["x_suffix"], r["x_domain"]) for r in got}
    assert {CASES[i][0]: by_id[i] for i in range(len(CASES))} == {h: (s, d) for h, s, d in CASES}
    assert by_id[100] == by_id[101] == by_id[102] == ("", "")
    assert U.with_public_suffix(df.limit(0), rules).count() == 0


def test_one_join(spark, rules):
    df = spark.createDataFrame([(1, "http://a.com")], "id int, url string")
    plan = U.with_public_suffix(df, rules)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
