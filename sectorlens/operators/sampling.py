"""Register sampling: A05, A06, W05, W06, F21, T01-T04."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .ordered import broadcast_if_small
from .registry import base_filter


def counts_by_code_and_municipality(companies: DataFrame, legal_forms: DataFrame | None = None,
                                    form_col: str = "legal_form") -> DataFrame:
    """Active, registered companies (F10) per (primary code, seat
    municipality), restricted to included legal forms; computed once for all
    groups."""
    c = companies.filter(base_filter())
    if legal_forms is not None:
        forms = broadcast_if_small(legal_forms.select(F.col(legal_forms.columns[0]).alias(form_col)).distinct())
        c = c.join(forms, form_col, "left_semi")
    return (c.groupBy(F.get(F.col("branch_codes"), 0).alias("sni_code"), "municipality_code")
            .agg(F.count(F.lit(1)).alias("cnt")))


def visit_key(mun: str = "municipality_code", seed: int | None = 42) -> Column:
    """The visiting order of municipalities: a seeded pseudo-random
    key, md5 of ``"<seed>:<code>"`` (``None`` = the code itself)."""
    if seed is None:
        return F.col(mun)
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(mun)))


def budgeted_selection(counts: DataFrame, limit: int = K.FETCH_LIMIT, seed: int | None = 42) -> DataFrame:
    """Per code, visit municipalities in ``visit_key`` order and take a
    whole municipality when the running total plus its count stays within
    ``limit``; stop once the total reaches ``limit``.

    The per-code list has one entry per municipality (a bounded dimension),
    so the fold runs as one native ``aggregate`` per code.
    Returns ``(sni_code, municipality_code, cnt)`` of the taken ones.
    """
    x = counts.select("sni_code", F.struct(visit_key("municipality_code", seed).alias("r"),
                                           F.col("municipality_code").alias("m"),
                                           F.col("cnt").cast("long").alias("c")).alias("e"))
    per = x.groupBy("sni_code").agg(F.array_sort(F.collect_list("e")).alias("es"))
    init = F.struct(F.lit(0).cast("long").alias("t"),
                    F.array().cast("array<struct<m:string,c:bigint>>").alias("sel"))

    def step(acc, e):
        take = (acc["t"] < limit) & (acc["t"] + e["c"] <= limit)
        return F.when(take, F.struct((acc["t"] + e["c"]).alias("t"),
                                     F.concat(acc["sel"], F.array(F.struct(e["m"].alias("m"),
                                                                           e["c"].alias("c")))).alias("sel"))
                      ).otherwise(acc)

    folded = per.select("sni_code", F.aggregate("es", init, step)["sel"].alias("sel"))
    return folded.select("sni_code", F.inline("sel")).select(
        "sni_code", F.col("m").alias("municipality_code"), F.col("c").alias("cnt"))


def sampled_companies(companies: DataFrame, selection: DataFrame) -> DataFrame:
    """W05 output rows: active, registered companies (F10) of the taken (code, municipality) pairs."""
    # at most codes x municipalities rows: broadcast behind the check
    sel = broadcast_if_small(selection.select("sni_code", "municipality_code"))
    return (companies.filter(base_filter()).withColumn("sni_code", F.get(F.col("branch_codes"), 0))
            .join(sel, ["sni_code", "municipality_code"], "left_semi"))


def fetched_total(selection: DataFrame) -> DataFrame:
    """Running total of fetched companies (sum over the fetch log)."""
    return selection.agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("count"))


def last_code(companies: DataFrame) -> DataFrame:
    """Primary code of the newest company (NULL when there is none)."""
    return companies.agg(F.max_by(F.get(F.col("branch_codes"), 0), F.col("company_id")).alias("last_code"))


def code_range(codes: DataFrame, last: Column | str | None, start: str = K.CODE_RANGE[0],
               stop: str = K.CODE_RANGE[1]) -> DataFrame:
    """F21 + T01: codes to visit: != last, >= max(start, last), <= stop, in
    string order."""
    c = F.col("sni_code")
    if last is None:
        cond = (c >= start) & (c <= stop)
    else:
        lastc = F.lit(last) if isinstance(last, str) else last
        lo = F.when(lastc.isNotNull() & (lastc > F.lit(start)), lastc).otherwise(F.lit(start))
        cond = (lastc.isNull() | (c != lastc)) & (c >= lo) & (c <= stop)
    return codes.filter(cond).orderBy("sni_code")


def newest(df: DataFrame, order_col: str = "company_id") -> DataFrame:
    """The newest row (global top-1)."""
    return df.orderBy(F.desc(order_col)).limit(1)


def first_match(df: DataFrame, key: str, order_col: str = "company_id") -> DataFrame:
    """First match per key (smallest ``order_col``)."""
    other = [c for c in df.columns if c not in (key,)]
    return (df.groupBy(key).agg(F.min_by(F.struct(*other), F.col(order_col)).alias("_m"))
            .select(key, "_m.*"))
