"""Input views derived from the given synthetic tables (Spark side).

These give the company register, scraped pages, extracted documents,
labelled documents, pseudo-scores and search hits that the operators
consume. They are derived row-for-row from ``customer``, ``nation``,
``pages`` and ``documents`` so their size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# The five industry codes of the test register, with the
# market segment each stands for and its position in the label list.
SNI_ROWS = [
    ("10111", "slaughter", "AUTOMOBILE", 0),
    ("10112", "cutting", "BUILDING", 1),
    ("10200", "fish", "FURNITURE", 2),
    ("38110", "waste", "MACHINERY", 3),
    ("38320", "recovery", "HOUSEHOLD", 4),
]


def v_sni(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SNI_ROWS, "sni_code string, description string, segment string, label_pos int")


def _case_mod(col, m: int, mapping: dict, default=None):
    key = col % m
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default) if default is not None else expr


def v_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").alias("c")
    n = table(spark, sf_dir, "nation").alias("n")
    s = F.broadcast(v_sni(spark)).alias("s")   # 5 fixed rows
    k = F.col("c.c_custkey")
    url_real = F.concat(F.lit("http://www.c"), k.cast("string"), F.lit(".example."),
                        F.when(k % 2 == 0, "com").otherwise("net"))
    # nation is left to the planner (its file statistics decide a broadcast)
    return (c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
             .join(s, F.col("s.segment") == F.col("c.c_mktsegment"), "left")
             .select(
                 k.alias("company_id"),
                 F.lpad(k.cast("string"), 10, "0").alias("org_nr"),
                 F.concat(F.col("c.c_name"),
                          _case_mod(k, 3, {0: " Aktiebolag", 1: " Handelsbolag"}, "")).alias("name"),
                 F.lpad(F.col("c.c_nationkey").cast("string"), 4, "0").alias("municipality_code"),
                 F.col("n.n_name").alias("municipality"),
                 _case_mod(k, 4, {0: "49", 1: "31", 2: "51"}, "10").alias("legal_form"),
                 F.when(k % 13 == 0, "0").otherwise("1").alias("company_status"),
                 F.when(k % 17 == 0, "0").otherwise("1").alias("registration_status"),
                 (k % 20).alias("n_workplaces"),
                 F.when(k % 11 == 0, F.array(F.col("s.sni_code"), F.lit("10111"), F.lit("38320")))
                  .when(k % 3 == 0, F.array(F.col("s.sni_code"), F.lit("38110")))
                  .otherwise(F.array(F.col("s.sni_code"))).alias("branch_codes"),
                 F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.lit(None).cast("string"))
                  .when(k % 7 == 2, F.lit("  ")).when(k % 7 == 3, F.lit("a b"))
                  .otherwise(url_real).alias("url"),
             ))


def v_scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    label = F.when(pid % 10 == 9, F.concat(F.lit("X"), pid.cast("string"))) \
             .otherwise(F.lpad((pid % 40).cast("string"), 10, "0"))
    return p.select(label.alias("label"), "url", F.col("html").alias("raw_html"), "page_id")


def v_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    run_ts = F.when(did % 300 < 150, F.lit("2024-01-01 00:00:00")) \
              .otherwise(F.lit("2024-02-01 00:00:00")).cast("timestamp")
    return d.select("doc_id", (did % 150).alias("company_id"), run_ts.alias("run_ts"),
                    F.col("text").alias("data"))


LANG_LABEL = {"en": "10111", "de": "10112", "fr": "38110"}


def v_labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = F.when(F.col("lang") == "en", "10111").when(F.col("lang") == "de", "10112") \
           .when(F.col("lang") == "fr", "38110").otherwise("38320")
    return d.select("doc_id", "text", "n_chars", lab.alias("true_label"))


# Labels of the pseudo-scores beyond the register's codes, so that cut-offs of 5 and 10 bind.
MORE_LABELS = ["01110", "10891", "13100", "38210", "41200", "46390", "56100", "62010", "85520"]


def v_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic pseudo-scores: one row per document with an array
    ``scored`` of (label, label_pos, score) over a fixed label list."""
    d = v_labelled_docs(spark, sf_dir).select("doc_id", "true_label")
    labels = [code for code, *_ in SNI_ROWS] + MORE_LABELS

    def entry(pos: int, label: str):
        score = ((F.col("doc_id") * 7919 + pos * 104729) % 1000) / F.lit(1000.0)
        return F.struct(F.lit(label).alias("label"), F.lit(pos).alias("label_pos"), score.alias("score"))
    return d.select("doc_id", "true_label", F.array(*[entry(i, c) for i, c in enumerate(labels)]).alias("scored"))


def v_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_score_rows`` in long form, one row per document and label."""
    return v_score_rows(spark, sf_dir).select("doc_id", "true_label", F.inline("scored"))


def v_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = v_companies(spark, sf_dir)
    cid = F.col("company_id")
    link = F.when(cid % 5 == 0, F.lit("https://www.facebook.com/x")) \
            .when(cid % 5 == 1, F.lit("")) \
            .otherwise(F.concat(F.lit("https://www.f"), cid.cast("string"), F.lit(".example.org")))
    return c.select(F.lower("name").alias("name"), "company_id", F.lit(1).alias("rank"),
                    link.alias("link"))


def v_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    html = F.concat(
        F.lit('<a href="tel:0'), (k % 10).cast("string"), F.lit('-12 34 5'), (k % 3).cast("string"),
        F.lit('">t</a><a href="mailto:u'), (k % 50).cast("string"), F.lit('@example.org">m</a>'),
        F.lit('<a href="/om/oss">om</a><a href="/en/about">about</a>'))
    return c.select(k.alias("page_id"), html.alias("html"))


def register_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide register row, with decoy columns P01 must ignore."""
    c = v_companies(spark, sf_dir)
    bc = F.col("branch_codes")
    return c.select(
        F.col("company_id"),
        F.col("name").alias("Företagsnamn"),
        F.col("org_nr").alias("OrgNr"),
        F.col("municipality_code").alias("Säteskommun, kod"),
        F.col("municipality").alias("Säteskommun"),
        F.get(bc, 0).alias("Bransch_1, kod"),
        F.get(bc, 1).alias("Bransch_2, kod"),
        F.get(bc, 2).alias("Bransch_3, kod"),
        F.lit("decoy").alias("Bransch_1"),
        F.lit("99999").alias("Bransch_1P, kod"),
        F.lit("88888").alias("Bransch_1HAE, kod"),
    )
