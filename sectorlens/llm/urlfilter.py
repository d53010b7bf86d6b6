"""Operator 7: URL filters by rules and by propagation over the link graph of hosts.

A url is judged by the longest rule that fits its host and path. Urls without
a rule take their host's verdict. Hosts whose pages mostly fall under allow
rules are trusted seeds, those mostly under block rules blocked seeds. Links
between pages are summed to weighted host edges; personalised PageRank sends
trust along them from the trusted seeds, and distrust against them from the
blocked seeds. A host is blocked if its distrust is above its trust and at
least ``THRESHOLD`` of a blocked seed's mean share.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule, and is allowed; null html has no links; relative links stay on their
host and move nothing; repeated rows count as pages of their own; rank sent
to hosts without links is not passed on; without blocked seeds no host is
blocked; no pages, no rows; input columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import broadcast_checked, stored

Rule = tuple[str, str, str]
# The rules as (host, path, verdict).
RULES: tuple[Rule, ...] = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
                           ("net", "/es/", "block"), ("net", "/fr/", "block"))
DAMPING, LEAST_FRONT = 0.85, 1e-6
#: Links after which damping alone leaves less than LEAST_FRONT of both kinds.
ROUNDS = math.ceil(math.log(LEAST_FRONT / (2 * (1 - DAMPING)), DAMPING))
FOLD = 8
SEED_SHARE, THRESHOLD = 0.5, 0.2
LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def lower_az(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return F.coalesce(lower_az(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"),) * 2


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from pages of one host to another, summed before the shuffle."""
    links = pages.select(url_host(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("dst"))
    return (links.select("src", lower_az(F.col("dst")).alias("dst")).where("src != '' and src != dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def host_seeds(judged: DataFrame, share: float = SEED_SHARE) -> DataFrame:
    """(kind, host, value): seeds of each kind with equal values summing to 1."""
    per = judged.where("host != ''").groupBy("host").agg(
        F.avg((F.col("rule_verdict").eqNullSafe("allow")).cast("double")).alias("trust"),
        F.avg((F.col("rule_verdict").eqNullSafe("block")).cast("double")).alias("distrust"))
    kind = F.when(F.col("distrust") >= share, "distrust").when(F.col("trust") >= share, "trust")
    seeds = per.select("host", kind.alias("kind")).where("kind is not null")
    count = seeds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return seeds.join(F.broadcast(count), "kind").select("kind", "host", (1 / F.col("n")).alias("value"))  # two rows


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, least: float = LEAST_FRONT) -> DataFrame:
    """(host, trust, distrust): personalised PageRank of both kinds.

    The rank is the sum of what reaches a host after 0, 1, 2, ... links. Each
    round moves only the newest part (the front) and stores it, until all that
    is left of it is at most ``least`` of the smallest seed; damping brings
    that about whatever the links. Every ``FOLD`` rounds the fronts are added
    to a stored sum.
    """
    forward = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    both = forward.unionByName(back)
    total = both.groupBy("kind", "host").agg(F.sum("n").alias("total"))
    moves = stored(both.join(total, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("total")).alias("share")),
                   "host_moves")
    front = stored(seeds.withColumn("value", F.col("value") * (1 - damping)), "front")
    enough = least * (seeds.agg(F.min("value")).first()[0] or 0.0)
    fronts = [front]
    while (front.agg(F.sum("value")).first()[0] or 0.0) > enough:
        front = stored(front.join(moves, ["kind", "host"]).groupBy("kind", F.col("to").alias("host"))
                       .agg(F.sum(F.col("value") * F.col("share") * damping).alias("value")), "front")
        fronts.append(front)
        if len(fronts) > FOLD:
            fronts = [stored(reduce(DataFrame.unionByName, fronts).groupBy("kind", "host")
                             .agg(F.sum("value").alias("value")), "ranks")]
    return (reduce(DataFrame.unionByName, fronts).groupBy("host")
            .agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("value"))), F.lit(0.0)).alias(k)
                   for k in ("trust", "distrust")]))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD,
               keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """``keep`` columns plus host, path, rule, verdict, trust and distrust of the host."""
    made = ("host", "path", "rule", "verdict", "trust", "distrust")
    row = F.struct(*[F.col(f"`{c}`") for c in keep if c not in made])
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rule, verdict = rule_of(host, path, rules)
    judged = pages.select(row.alias("row"), host.alias("host"), path.alias("path"), rule.alias("rule"),
                          verdict.alias("rule_verdict"))
    seeds = stored(host_seeds(judged.select("host", "rule_verdict")), "host_seeds")
    hosts = propagate(seeds, stored(host_edges(pages), "host_edges"))
    mean = seeds.where("kind = 'distrust'").agg(F.max("value")).first()[0]  # equal for all blocked seeds
    least = threshold * (1 - DAMPING) * (mean or 0.0)
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= least)
    verdicts = stored(hosts.select(F.col("host").alias("ranked"), "trust", "distrust", blocked.alias("blocked")), "host_verdicts")
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return (judged.join(broadcast_checked(verdicts), F.col("host") == F.col("ranked"), "left")
            .select("row.*", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"),
                    *[F.coalesce(F.col(k), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]))
