"""Queries for evaluation: W04, W07, W08, A07-A12, E11-E14, F24, J06, M10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluate as V
from ..sources import fixtures as fx
from .registry import query

MIN_CHARS = 300


def _docs(spark, sf):
    """Evaluation documents: one page each, so the text is ' ' + page text."""
    d = fx.v_labelled_docs(spark, sf)
    return d.select("doc_id", "true_label", F.concat(F.lit(" "), F.col("text")).alias("text"))


RANKED_SQL = """SELECT doc_id, true_label, label, label_pos, score,
  row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label_pos) AS rank FROM v_scores"""
IND_SQL = """SELECT doc_id, true_label,
  max(CASE WHEN label = true_label AND rank = 1 THEN 1 ELSE 0 END) AS correct_label,
  max(CASE WHEN label = true_label AND rank <= 5 THEN 1 ELSE 0 END) AS top_n_label,
  max(CASE WHEN substring(label, 1, 2) = substring(true_label, 1, 2) AND rank = 1 THEN 1 ELSE 0 END) AS correct_category,
  max(CASE WHEN substring(label, 1, 2) = substring(true_label, 1, 2) AND rank <= 5 THEN 1 ELSE 0 END) AS top_n_category,
  coalesce(1.0e0 / max(CASE WHEN substring(label, 1, 2) = substring(true_label, 1, 2) THEN rank END), 0.0e0) AS wref,
  coalesce(1.0e0 / min(CASE WHEN substring(label, 1, 2) = substring(true_label, 1, 2) THEN rank END), 0.0e0) AS wclean
FROM ranked GROUP BY doc_id, true_label"""
FLAGS_SQL = """SELECT doc_id, true_label, CASE WHEN length(' ' || text) < 300 THEN 1 ELSE 0 END AS skipped
FROM v_labelled_docs"""
PER_LABEL_SQL = """SELECT f.true_label AS label,
  CAST(sum(CASE WHEN f.skipped = 0 THEN coalesce(i.correct_label, 0) ELSE 0 END) AS BIGINT) AS correct_label,
  CAST(sum(CASE WHEN f.skipped = 0 THEN coalesce(i.top_n_label, 0) ELSE 0 END) AS BIGINT) AS top_n_label,
  CAST(sum(CASE WHEN f.skipped = 0 THEN coalesce(i.correct_category, 0) ELSE 0 END) AS BIGINT) AS correct_category,
  CAST(sum(CASE WHEN f.skipped = 0 THEN coalesce(i.top_n_category, 0) ELSE 0 END) AS BIGINT) AS top_n_category,
  sum(CASE WHEN f.skipped = 0 THEN coalesce(i.wref, 0) ELSE 0 END) AS weighted_category_score,
  CAST(sum(f.skipped) AS BIGINT) AS skipped, CAST(sum(1 - f.skipped) AS BIGINT) AS label_count
FROM flags f LEFT JOIN ind i ON i.doc_id = f.doc_id GROUP BY f.true_label"""
EVAL = {"ranked": RANKED_SQL, "ind": IND_SQL, "flags": FLAGS_SQL, "per_label": PER_LABEL_SQL}


def _per_label(spark, sf, mode="reference"):
    per, tot = V.evaluate(_docs(spark, sf), fx.v_score_rows(spark, sf), top_n=5, min_chars=MIN_CHARS, mode=mode)
    return per, tot


@query("w04_rank_labels", "SELECT doc_id, label, rank FROM ranked", extra={"ranked": RANKED_SQL})
def w04(spark, sf):
    return V.rank_labels(fx.v_score_rows(spark, sf)).select("doc_id", "label", F.col("rank").cast("long").alias("rank"))


@query("w07_top_labels_with_description",
       """SELECT r.doc_id, r.label, r.rank, s.description FROM ranked r LEFT JOIN v_sni s ON s.sni_code = r.label
WHERE r.rank <= 10""", extra={"ranked": RANKED_SQL})
def w07(spark, sf):
    t = V.top_labels(fx.v_score_rows(spark, sf), fx.v_sni(spark), n=10)
    return t.select("doc_id", "label", F.col("rank").cast("long").alias("rank"), "description")


@query("j06_prediction_descriptions",
       """SELECT r.doc_id, r.label, s.description FROM ranked r LEFT JOIN v_sni s ON s.sni_code = r.label WHERE r.rank = 1""",
       extra={"ranked": RANKED_SQL})
def j06(spark, sf):
    t = V.top_labels(fx.v_score_rows(spark, sf), fx.v_sni(spark), n=1)
    return t.select("doc_id", "label", "description")


@query("w08_doc_indicators",
       """SELECT doc_id, true_label, correct_label, top_n_label, correct_category, top_n_category,
       round(wref, 6) AS weighted_category_score FROM ind""", extra={"ranked": RANKED_SQL, "ind": IND_SQL})
def w08(spark, sf):
    i = V.doc_indicators(fx.v_score_rows(spark, sf), 5, "reference")
    return i.withColumn("weighted_category_score", F.round("weighted_category_score", 6))


@query("w08_doc_indicators_clean",
       """SELECT doc_id, true_label, correct_label, top_n_label, correct_category, top_n_category,
       round(wclean, 6) AS weighted_category_score FROM ind""", extra={"ranked": RANKED_SQL, "ind": IND_SQL})
def w08c(spark, sf):
    i = V.doc_indicators(fx.v_score_rows(spark, sf), 5, "clean")
    return i.withColumn("weighted_category_score", F.round("weighted_category_score", 6))


@query("f24_skip_flags", FLAGS_SQL)
def f24(spark, sf):
    return V.skip_flags(_docs(spark, sf), "text", MIN_CHARS).select("doc_id", "true_label", "skipped")


@query("a07_label_results",
       """SELECT label, correct_label, top_n_label, correct_category, top_n_category,
       round(weighted_category_score, 6) AS weighted_category_score, skipped, label_count FROM per_label""",
       extra=EVAL)
def a07(spark, sf):
    per, _ = _per_label(spark, sf)
    return per.withColumn("weighted_category_score", F.round("weighted_category_score", 6))


@query("a08_total_results",
       """SELECT CAST(sum(correct_label) AS BIGINT) AS correct_label, CAST(sum(top_n_label) AS BIGINT) AS top_n_label,
       CAST(sum(correct_category) AS BIGINT) AS correct_category, CAST(sum(top_n_category) AS BIGINT) AS top_n_category,
       round(sum(weighted_category_score), 6) AS weighted_category_score, CAST(sum(skipped) AS BIGINT) AS skipped,
       CAST(sum(label_count) AS BIGINT) AS total_items FROM per_label""", extra=EVAL)
def a08(spark, sf):
    _, tot = _per_label(spark, sf)
    return tot.withColumn("weighted_category_score", F.round("weighted_category_score", 6))


_PCT = "round({x} / (CASE WHEN {n} > 0 THEN {n} ELSE 1 END) * 100, 3)"


@query("a09_label_report",
       f"""SELECT label, {_PCT.format(x='correct_label', n='label_count')} AS pct_correct_label,
       {_PCT.format(x='top_n_label', n='label_count')} AS pct_top_n_label,
       {_PCT.format(x='correct_label', n='label_count')} AS pct_correct_category,
       {_PCT.format(x='top_n_category', n='label_count')} AS pct_top_n_category,
       round(weighted_category_score, 2) AS weighted_category_score, label_count FROM per_label""", extra=EVAL)
def a09(spark, sf):
    per, _ = _per_label(spark, sf)
    return V.label_report(per, "reference")


@query("a09_total_report",
       f"""SELECT total_items, skipped, {_PCT.format(x='correct_label', n='total_items')} AS pct_correct_label,
       {_PCT.format(x='top_n_label', n='total_items')} AS pct_top_n_label,
       {_PCT.format(x='correct_category', n='total_items')} AS pct_correct_category,
       {_PCT.format(x='top_n_category', n='total_items')} AS pct_top_n_category,
       round(weighted_category_score, 3) AS weighted_category_score FROM (
  SELECT sum(correct_label) AS correct_label, sum(top_n_label) AS top_n_label, sum(correct_category) AS correct_category,
         sum(top_n_category) AS top_n_category, sum(weighted_category_score) AS weighted_category_score,
         CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(label_count) AS BIGINT) AS total_items FROM per_label)""",
       extra=EVAL)
def a09t(spark, sf):
    _, tot = _per_label(spark, sf)
    return V.total_report(tot)


@query("a09_total_report_clean",
       f"""SELECT total_items, skipped, {_PCT.format(x='correct_label', n='total_items')} AS pct_correct_label,
       {_PCT.format(x='top_n_label', n='total_items')} AS pct_top_n_label,
       {_PCT.format(x='correct_category', n='total_items')} AS pct_correct_category,
       {_PCT.format(x='top_n_category', n='total_items')} AS pct_top_n_category,
       round(CASE WHEN total_items > 0 THEN weighted_category_score / total_items ELSE 0.0e0 END, 3)
         AS weighted_category_score FROM (
  SELECT sum(correct_label) AS correct_label, sum(top_n_label) AS top_n_label, sum(correct_category) AS correct_category,
         sum(top_n_category) AS top_n_category, sum(weighted_category_score) AS weighted_category_score,
         CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(label_count) AS BIGINT) AS total_items FROM per_label)""",
       extra=EVAL)
def a09tc(spark, sf):
    _, tot = _per_label(spark, sf)
    return V.total_report(tot, "clean")


@query("a12_label_report_clean_sorted",
       f"""SELECT label, {_PCT.format(x='correct_label', n='label_count')} AS pct_correct_label,
       {_PCT.format(x='top_n_label', n='label_count')} AS pct_top_n_label,
       {_PCT.format(x='correct_category', n='label_count')} AS pct_correct_category,
       {_PCT.format(x='top_n_category', n='label_count')} AS pct_top_n_category,
       round(weighted_category_score, 2) AS weighted_category_score, label_count FROM per_label ORDER BY label""",
       extra=EVAL)
def a12(spark, sf):
    per, _ = _per_label(spark, sf)
    return V.label_report(per, "clean")


@query("m10_evaluation_job",
       """SELECT label, correct_label, top_n_label, correct_category, top_n_category,
       round(weighted_category_score, 6) AS weighted_category_score, skipped, label_count FROM per_label""",
       extra=EVAL)
def m10(spark, sf):
    per, _ = V.evaluate(_docs(spark, sf), fx.v_score_rows(spark, sf), 5, MIN_CHARS, "reference")
    return per.withColumn("weighted_category_score", F.round("weighted_category_score", 6))


PRF_SQL = """SELECT label, tp, fp, fn,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0e0 END AS p,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0e0 END AS r
FROM (SELECT label,
  CAST(sum(CASE WHEN score >= 0.368 AND label = true_label THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN score >= 0.368 AND label <> true_label THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN score < 0.368 AND label = true_label THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM v_scores GROUP BY label)"""


@query("a10_multilabel_per_label",
       """SELECT label, tp, fp, fn, round(p, 6) AS p, round(r, 6) AS r,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0e0 END, 6) AS f FROM prf""", extra={"prf": PRF_SQL})
def a10(spark, sf):
    per, _ = V.multilabel_scores(fx.v_scores(spark, sf))
    return per.select("label", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("p", "r", "f")])


@query("a10_multilabel_totals",
       """SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
       round(avg(p), 6) AS macro_p, round(avg(r), 6) AS macro_r,
       round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0e0 END), 6) AS macro_f,
       round(CASE WHEN sum(tp) + sum(fp) > 0 THEN sum(tp) / (sum(tp) + sum(fp)) ELSE 0.0e0 END, 6) AS micro_p,
       round(CASE WHEN sum(tp) + sum(fn) > 0 THEN sum(tp) / (sum(tp) + sum(fn)) ELSE 0.0e0 END, 6) AS micro_r
FROM prf""", extra={"prf": PRF_SQL})
def a10t(spark, sf):
    _, tot = V.multilabel_scores(fx.v_scores(spark, sf))
    return tot.select("tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in
                                          ("macro_p", "macro_r", "macro_f", "micro_p", "micro_r")])


AUC_SQL = """SELECT label, npos, n - npos AS nneg,
  CASE WHEN npos > 0 AND n - npos > 0 THEN (rs - npos * (npos + 1) / 2.0e0) / (npos * (n - npos)) END AS auc
FROM (SELECT label, sum(pos) AS npos, count(*) AS n, sum(CASE WHEN pos = 1 THEN avg_rank ELSE 0 END) AS rs
  FROM (SELECT label, pos, rank() OVER (PARTITION BY label ORDER BY score)
               + (count(*) OVER (PARTITION BY label, score) - 1) / 2.0e0 AS avg_rank
        FROM (SELECT label, score, CASE WHEN label = true_label THEN 1 ELSE 0 END AS pos FROM v_scores))
  GROUP BY label)"""


@query("a11_label_auc", "SELECT label, CAST(npos AS BIGINT) AS npos, CAST(nneg AS BIGINT) AS nneg, round(auc, 6) AS auc FROM auc",
       extra={"auc": AUC_SQL})
def a11(spark, sf):
    per, _ = V.label_auc(fx.v_scores(spark, sf))
    return per.select("label", F.col("npos").cast("long").alias("npos"), F.col("nneg").cast("long").alias("nneg"),
                      F.round("auc", 6).alias("auc"))


@query("a11_macro_auc", "SELECT round(avg(auc), 6) AS macro_auc FROM auc", extra={"auc": AUC_SQL})
def a11m(spark, sf):
    _, macro = V.label_auc(fx.v_scores(spark, sf))
    return macro.select(F.round("macro_auc", 6).alias("macro_auc"))


@query("e11_category_match",
       "SELECT doc_id, label, substring(label, 1, 2) = substring(true_label, 1, 2) AS same_category FROM v_scores")
def e11(spark, sf):
    s = fx.v_scores(spark, sf)
    return s.select("doc_id", "label", (T.category("label") == T.category("true_label")).alias("same_category"))


@query("e12_label_match", "SELECT doc_id, label, label = true_label AS same_label FROM v_scores")
def e12(spark, sf):
    s = fx.v_scores(spark, sf)
    return s.select("doc_id", "label", (F.col("label") == F.col("true_label")).alias("same_label"))


@query("e13_reciprocal_rank", "SELECT doc_id, label, round(1.0e0 / rank, 6) AS rr FROM ranked",
       extra={"ranked": RANKED_SQL})
def e13(spark, sf):
    r = V.rank_labels(fx.v_score_rows(spark, sf))
    return r.select("doc_id", "label", F.round(T.reciprocal_rank("rank"), 6).alias("rr"))


@query("e14_percentage",
       f"SELECT label, {_PCT.format(x='top_n_category', n='label_count')} AS pct FROM per_label", extra=EVAL)
def e14(spark, sf):
    per, _ = _per_label(spark, sf)
    return per.select("label", T.percentage("top_n_category", "label_count").alias("pct"))
