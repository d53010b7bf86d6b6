"""Url path, host, registered domain and suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.ordered import broadcast_if_small
from .text import _c

_PATH = r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)"
_HOST = r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//)?(?:[^@/?#]*@)?([^:/?#]*)"
_IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"
MAX_SUFFIX_LABELS = 4
BUILT_IN_LABELS = max(s.count(".") + 1 for s in K.PUBLIC_SUFFIXES)


def url_path(url) -> Column:
    """RFC-3986 path without query/fragment and without ``;params``
    of the last segment (what Python's ``urlparse(...).path`` returns)."""
    return F.regexp_replace(F.regexp_extract(_c(url), _PATH, 1), ";[^/]*$", "")


def url_host(url) -> Column:
    """Lower-cased host of a url, with or without a scheme ('' when there is none)."""
    return F.lower(F.regexp_extract(_c(url), _HOST, 1))


def suffix_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in K.PUBLIC_SUFFIXES], "suffix string")


def _tail(labels: Column, n: int) -> Column:
    """The last ``n`` labels, null if the host has no label before them."""
    return F.when(F.size(labels) > n, F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def with_registered_domain(df: DataFrame, url_col: str = "url", prefix: str = "",
                           suffixes: DataFrame | None = None) -> DataFrame:
    """Add ``{prefix}host``, ``{prefix}domain`` (label left of the
    suffix) and ``{prefix}suffix`` by the longest known public suffix.

    ``suffixes`` is a table whose first column lists public suffixes of up to
    ``MAX_SUFFIX_LABELS`` labels; it is joined once per length (broadcast when
    its size allows). Without it a small built-in list is matched inside the
    expression. A host that ends in no known suffix has its last label as the
    suffix; an IP address or a single label is a domain without suffix.
    """
    labels = F.col("_labels")
    # the labels are a projection of their own: nested in each later use they would outgrow the generated code
    out = df.withColumn(f"{prefix}host", url_host(url_col)).withColumn("_labels", F.split(F.col(f"{prefix}host"), r"\."))
    if suffixes is None:
        listed = F.array(*[F.array(*[F.lit(s) for s in K.PUBLIC_SUFFIXES if s.count(".") == n - 1]) for n in range(BUILT_IN_LABELS, 0, -1)])
        tails = F.array(*[_tail(labels, n) for n in range(BUILT_IN_LABELS, 0, -1)])
        found = [F.get(F.filter(tails, lambda t, i: t.isNotNull() & F.array_contains(F.get(listed, i), t)), 0)]
    else:
        listed = broadcast_if_small(suffixes.select(F.lower(F.col(suffixes.columns[0])).alias("_suffix")).distinct())
        found = []
        for n in range(MAX_SUFFIX_LABELS, 0, -1):
            out = out.withColumn("_tail", _tail(labels, n)) \
                .join(listed.withColumnRenamed("_suffix", f"_s{n}"), F.col("_tail") == F.col(f"_s{n}"), "left").drop("_tail")
            found.append(F.col(f"_s{n}"))
    plain = (F.size(labels) < 2) | F.col(f"{prefix}host").rlike(_IPV4)
    suffix = F.when(plain, "").otherwise(F.coalesce(*found, F.element_at(labels, -1)))
    n_suffix = F.size(F.split(F.col(f"{prefix}suffix"), r"\."))
    domain = F.when(F.col(f"{prefix}suffix") == "", F.col(f"{prefix}host")) \
        .otherwise(F.get(labels, F.size(labels) - n_suffix - 1))
    out = out.withColumn(f"{prefix}suffix", F.coalesce(suffix, F.lit("")))
    return out.withColumn(f"{prefix}domain", F.coalesce(domain, F.lit(""))) \
        .drop("_labels", *[f"_s{n}" for n in range(1, MAX_SUFFIX_LABELS + 1)])


def registered_domain(prefix: str = "") -> Column:
    d, s = F.col(f"{prefix}domain"), F.col(f"{prefix}suffix")
    return F.when(s == "", d).otherwise(F.concat_ws(".", d, s))


def _ascii_hosts(batches):
    """Hosts with the ASCII form of their labels (a label that has none stays)."""
    def label(x: str) -> str:
        try:
            done = x.encode("idna").decode()
        except UnicodeError:
            return x
        return x if "." in done else done
    for batch in batches:
        yield batch.assign(norm=[".".join(label(x) for x in h.split(".")) for h in batch["host"]])


def _with_ascii_form(hosts: DataFrame) -> DataFrame:
    """(host, norm): only hosts with other than ASCII characters pass through Python."""
    plain = F.col("host").rlike(r"^[\x00-\x7F]*$")
    return (hosts.where(plain).withColumn("norm", F.col("host"))
            .unionByName(hosts.where(~plain).mapInPandas(_ascii_hosts, "host string, norm string")))


def suffix_rules(lines: DataFrame) -> DataFrame:
    """The rules of a published suffix list (its first column holds the lines), each as a join key.

    Blank lines and comments go; a rule ends at the first white space. ``*.x``
    and ``!y.x`` keep their marks; labels take their ASCII form.
    """
    rule = F.lower(F.regexp_extract(F.col(lines.columns[0]), r"^\s*(\S+)", 1))
    kept = lines.select(rule.alias("rule")).where("rule != '' AND rule NOT LIKE '//%'")
    mark = F.regexp_extract("rule", r"^(!|\*\.)?", 0)
    bare = kept.select(mark.alias("mark"), F.regexp_replace("rule", r"^(!|\*\.)", "").alias("host"))
    norm = _with_ascii_form(bare.select("host").distinct())
    return bare.join(norm, "host").select(F.concat("mark", "norm").alias("rule")).distinct()


def with_public_suffix(df: DataFrame, rules: DataFrame, url_col: str = "url", prefix: str = "") -> DataFrame:
    """E19 by the published rules: ``{prefix}host``, ``{prefix}domain`` and ``{prefix}suffix``.

    ``rules`` comes from ``suffix_rules``. Every ending of a distinct host asks
    for its plain, wildcard and exception rule in one join; an exception wins
    and takes a label less, else the rule of most labels, else the last label
    is the suffix. An IP address or a single label is a domain without suffix; a
    host that is itself a suffix has an empty domain.
    """
    host = f"{prefix}host"
    out = df.withColumn(host, F.coalesce(url_host(url_col), F.lit("")))
    labels, n = F.split("norm", r"\."), F.size(F.split("norm", r"\."))

    def ending(k):
        return F.array_join(F.slice(labels, n - k + 1, k), ".")
    asked = F.transform(F.sequence(F.lit(1), n), lambda k: F.array(
        F.struct(k.alias("k"), ending(k).alias("rule")),
        F.struct(k.alias("k"), F.when(k > 1, F.concat(F.lit("*."), ending(k - 1))).alias("rule")),
        F.struct((k + 999).alias("k"), F.concat(F.lit("!"), ending(k)).alias("rule"))))
    hosts = _with_ascii_form(out.select(F.col(host).alias("host")).where("host != ''").distinct())
    hosts = hosts.where(~F.col("norm").rlike(_IPV4) & F.col("norm").contains("."))
    met = (hosts.select("host", F.inline(F.flatten(asked))).join(broadcast_if_small(rules), "rule")
           .groupBy("host").agg(F.max("k").alias("k")))
    # an exception's k is its labels + 999: a thousand more than the labels of the suffix it leaves
    size = F.coalesce(F.when(F.col("k") > 999, F.col("k") - 1000).otherwise(F.col("k")), F.lit(1))
    own = F.split("host", r"\.")
    split = hosts.join(met, "host", "left").select(
        F.col("host").alias("_h"), F.array_join(F.slice(own, F.size(own) - size + 1, size), ".").alias("_s"),
        F.coalesce(F.get(own, F.size(own) - size - 1), F.lit("")).alias("_d"))
    return (out.join(split, out[host] == F.col("_h"), "left")
            .withColumn(f"{prefix}domain", F.when(F.col("_h").isNull(), F.col(host)).otherwise(F.col("_d")))
            .withColumn(f"{prefix}suffix", F.coalesce("_s", F.lit(""))).drop("_h", "_s", "_d"))
