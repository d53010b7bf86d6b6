"""URL filters: rules against a plain restatement, ranks against a dense power series."""

import re

import numpy as np
import pytest

from sectorlens.llm import q_urls  # noqa: F401
from sectorlens.llm.registry import QUERIES
from sectorlens.llm.urlfilter import DAMPING, LEAST_FRONT, ROUNDS, RULES, THRESHOLD, host_edges, judge_urls, propagate
from tests.llm.common import SF


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fit = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def brute(pages):
    """page: (host, path, rule, verdict) by a dense matrix."""
    parts = [(*split(u), *rule(*split(u))) for _, u, _ in pages]
    links = [re.findall(r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)""", h or "") for _, _, h in pages]
    hosts = sorted({p[0] for p in parts if p[0]} | {x.lower() for li in links for x in li})
    n = len(hosts)
    edges = np.zeros((n, n))
    for p, li in zip(parts, links):
        for x in li:
            if p[0] and x.lower() != p[0]:
                edges[hosts.index(p[0]), hosts.index(x.lower())] += 1
    verdicts = {}
    share = {h: [[p[3] for p in parts if p[0] == h].count(v) / max(1, sum(p[0] == h for p in parts)) for v in ("allow", "block")]
             for h in hosts}
    bad = np.array([share[h][1] >= 0.5 for h in hosts], float)
    good = np.array([share[h][0] >= 0.5 and share[h][1] < 0.5 for h in hosts], float)
    ranks = []
    for seeds, m in ((good, edges), (bad, edges.T)):
        m = m / np.maximum(m.sum(1, keepdims=True), 1)
        front = (1 - DAMPING) * seeds / max(seeds.sum(), 1)
        total = front.copy()
        for _ in range(ROUNDS):
            front = DAMPING * front @ m
            total += front
        ranks.append(total)
    least = THRESHOLD * (1 - DAMPING) / max(bad.sum(), 1)
    verdicts = {h: "block" if bad.any() and d > t and d >= least else "allow" for h, t, d in zip(hosts, *ranks)}
    return [(h, p, r, v or verdicts.get(h, "allow")) for h, p, r, v in parts], dict(zip(hosts, zip(*ranks)))


PAGES = [
    (1, "http://A.example.COM/en/x?q#f", '<a href="http://good.org/1">'), (2, "https://www.example.com/en/", "<a href='//Spam.org/x'>"),
    (3, "http://m.spam.net/es/1", '<A HREF=https://farm.org/y>'), (4, "http://m.spam.net/fr/2", None),
    (5, "http://farm.org/", '<a href="http://m.spam.net/es/1"><a href="http://m.spam.net/de/"><a href="/rel">'),
    (6, "http://far.org/z", '<a href="http://farm.org/">'), (7, "http://good.org/1", '<a href="http://other.org/">' * 3),
    (8, "http://other.org", ""), (9, None, None), (10, "no scheme", "<a href='http://x.org/'>"), (11, "x://", "href="),
    (12, "http://m.spam.net/de/1", None), (13, "http://com/", None), (14, "http://com", None), (15, "http://net/fr/#", None),
    (16, "http://a//b://c.com/", None), (7, "http://good.org/1", None), (None, "http://xexample.com/en/", "x" * 100000),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "mine", 0) for r in rows], "page_id bigint, url string, html string, verdict string, ranked int")


def test_cases(spark):
    df = frame(spark, PAGES)
    got = judge_urls(df, keep=df.columns).collect()
    want, ranks = brute(PAGES)
    key = lambda r: [str(x) for x in r]
    assert sorted([(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got], key=key) == \
        sorted([(p[0], *w) for p, w in zip(PAGES, want)], key=key)
    for r in got:
        if r["host"]:
            assert (r["trust"], r["distrust"]) == pytest.approx(tuple(ranks[r["host"]]), abs=10 * LEAST_FRONT)
    by = {r["page_id"]: r["verdict"] for r in got}
    assert by[5] == by[12] == "block" and by[8] == by[7] == "allow"


def test_edges_and_empty(spark):
    df = frame(spark, PAGES)
    assert {tuple(r) for r in host_edges(df).collect()} >= {("good.org", "other.org", 3), ("farm.org", "m.spam.net", 2)}
    assert judge_urls(df.limit(0)).count() == 0
    assert {r["verdict"] for r in judge_urls(df.where("page_id > 7 and page_id < 10")).collect()} == {"allow"}


def test_whole_table(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = {tuple(r) for r in QUERIES["op7_url_filters"](spark, SF).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {(p[0], *w) for p, w in zip(pages, brute(pages)[0])}


def test_ranks_solve_the_linear_system(spark):
    """A ring, a chain of 25 hosts and a cross link: ranks are those of the solved system."""
    links = [("a", "b", 2), ("b", "c", 1), ("c", "a", 1), ("b", "h0", 3), ("h24", "a", 1)]
    links += [(f"h{i}", f"h{i + 1}", 1) for i in range(24)]
    seeds = [("trust", "a", 0.5), ("trust", "h3", 0.5), ("distrust", "c", 1.0)]
    got = propagate(spark.createDataFrame(seeds, "kind string, host string, value double"),
                    spark.createDataFrame(links, "src string, dst string, n bigint")).collect()
    hosts = sorted({h for li in links for h in li[:2]})
    m = np.zeros((len(hosts), len(hosts)))
    for s, d, n in links:
        m[hosts.index(s), hosts.index(d)] = n
    for kind, a in (("trust", m), ("distrust", m.T)):
        seed = np.array([sum(v for k, h, v in seeds if (k, h) == (kind, x)) for x in hosts])
        want = np.linalg.solve(np.eye(len(hosts)) - DAMPING * (a / a.sum(1, keepdims=True)).T, (1 - DAMPING) * seed)
        assert {r["host"]: r[kind] for r in got} == pytest.approx(dict(zip(hosts, want)), abs=10 * LEAST_FRONT)


def test_host_far_from_many_seeds(spark):
    """1,000 blocked seeds; a host 21 links from ten of them gets 4.9e-5, above the threshold of 3e-5."""
    pages = [(i, f"http://s{i}.net/es/", None) for i in range(1000)]
    pages.append((1001, "http://c1.org/", "".join(f'<a href="http://s{i}.net/">' for i in range(10))))
    pages += [(1000 + k, f"http://c{k}.org/", f'<a href="http://c{k - 1}.org/">') for k in range(2, 30)]
    got = {r["page_id"] - 1000: r for r in judge_urls(frame(spark, pages)).where("page_id > 1000").collect()}
    assert got[21]["distrust"] == pytest.approx(0.15 / 100 * DAMPING ** 21)
    assert all((r["verdict"] == "block") == (0.01 * DAMPING ** k >= THRESHOLD / 1000) for k, r in got.items())
