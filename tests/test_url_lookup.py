"""J05 as observed: the n-gram search against a regular-expression scan of every stored url."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.operators import enrich as N

PART = st.text(alphabet="abx-", min_size=1, max_size=6)
HOSTS = st.lists(PART, min_size=1, max_size=3).map(lambda p: ".".join(p) + ".se")


def scan(patterns, stored):
    """The first company of each pattern by searching every url."""
    rx = {p: re.compile(".".join(re.escape(x) for x in p.split("."))) for p in patterns}
    return {p: min((c for u, c in stored if u is not None and rx[p].search(u)), default=None) for p in patterns}


@settings(max_examples=6, deadline=None)
@given(st.sets(HOSTS, min_size=1, max_size=8), st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="abx.-/se", max_size=14)),
                                                                  st.integers(1, 40)), max_size=25))
def test_patterns(spark, hosts, urls):
    patterns = {*hosts, "", "a.b", "(a", "a.[x", "s", "é.se", *[h[:3] for h in hosts if not h[:3].strip(".") == ""]}
    patterns = {p for p in patterns if p == "" or p.strip(".")}
    stored = [*urls, ("http://www.(a.[x.se", 90), ("étse", 91), ("a.b", 92)]
    distinct = {}
    for u, c in stored:
        if u is not None:
            distinct[u] = min(c, distinct.get(u, c))
    frame = spark.createDataFrame(list(distinct.items()), "s_url string, company_id int")
    got = {r["pattern"]: r["company_id"] for r in N.first_by_pattern(spark.createDataFrame([(p,) for p in patterns], "pattern string"), frame).collect()}
    want = {p: c for p, c in scan(patterns, list(distinct.items())).items() if c is not None}
    assert got == want


COMPANIES = [(5, "http://www.acme.se/om"), (3, "https://shop.acme.se"), (9, "ftp://other.com"), (2, None), (8, "  "), (7, ""),
             *[(i, "http://hot.example.org") for i in range(100, 160)]]
LOOKUPS = [("http://www.acme.se/x", 5), ("https://mail.acme.se", 3), ("http://acme.se", 3), ("http://10.0.0.1/x", 3), ("http://localhost", 3),
           (None, 3), ("", 3), ("http://nobody.net", None), ("http://other.com", 9), ("http://xhot.example.org", 100), ("http://OTHER.com", 9),
           ("http://www-acme.se", None), ("http://ww.acme.se", 5), ("http://www.acme.se/x", 5)]


def test_lookup(spark):
    """Host first, then registered domain; hosts without a suffix match every stored url; repeated lookups each get a row."""
    companies = spark.createDataFrame(COMPANIES, "company_id int, url string")
    urls = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(LOOKUPS)], "qid int, url string")
    got = {r["qid"]: r["company_id"] for r in N.company_by_url_reference(urls, companies).collect()}
    assert got == {i: c for i, (_, c) in enumerate(LOOKUPS)}
    assert N.company_by_url_reference(urls, companies).columns == ["qid", "url", "company_id"]
    none = N.company_by_url_reference(urls, companies.limit(0)).collect()
    assert len(none) == len(LOOKUPS) and all(r["company_id"] is None for r in none)
    assert N.company_by_url_reference(urls.limit(0), companies).count() == 0


def test_plan(spark):
    companies = spark.createDataFrame(COMPANIES, "company_id int, url string")
    urls = spark.createDataFrame([(0, "http://www.acme.se")], "qid int, url string")
    plan = N.company_by_url_reference(urls, companies)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
