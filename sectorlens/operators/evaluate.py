"""Evaluation: E11-E14, F24, J06, W04, W07, W08, A07-A12, M10.

Predictions have one row per document with an array ``scored`` of (label,
label_pos, score); ranking and document indicators work inside the row,
without a shuffle. Per-label statistics (A10, A11) take the long form, one
row per document and label, with decomposable aggregates; the AUC counts a
histogram per label and ranks only the scores of bins that hold positives and
negatives, by the skew-safe ``prefix_rank``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import category, percentage
from ..session import staged
from .ordered import broadcast_if_small, planned_bytes, prefix_rank

COUNTERS = ["correct_label", "top_n_label", "correct_category", "top_n_category"]


def ranked_labels(scored: Column | str = "scored") -> Column:
    """The labels of one document by score, descending; ties keep label
    order (``label_pos``). ``scored``: array of (label, label_pos, score);
    result: array of (label, rank, score), sorted inside the row."""
    x = F.col(scored) if isinstance(scored, str) else scored
    by = F.array_sort(F.transform(x, lambda e: F.struct((-e["score"]).alias("minus"), e["label_pos"].alias("pos"),
                                                        e["label"].alias("label"), e["score"].alias("score"))))
    return F.transform(by, lambda e, i: F.struct(e["label"].alias("label"), (i + 1).alias("rank"), e["score"].alias("score")))


def rank_labels(pred: DataFrame) -> DataFrame:
    """W04 in long form: ``pred`` has one row per document with ``scored``."""
    rest = [c for c in pred.columns if c != "scored"]
    return pred.select(*rest, F.inline(ranked_labels()))


def top_labels(pred: DataFrame, codes: DataFrame, n: int = 10) -> DataFrame:
    """W07 + J06: top ``n`` labels per document with the code description."""
    rest = [c for c in pred.columns if c != "scored"]
    top = pred.select(*rest, F.inline(F.slice(ranked_labels(), 1, n)))
    desc = broadcast_if_small(codes.select(F.col("sni_code").alias("label"), "description"))
    return top.join(desc, "label", "left")


def doc_indicators(pred: DataFrame, top_n: int = K.TOP_N, mode: str = "reference") -> DataFrame:
    """Per document, top-1/top-N label and category hits and the
    weighted category score (reference: 1/rank of the last-ranked label of
    the true category; clean: of the first). All of it is read off the
    document's own ranked array."""
    labels = F.transform("ranked", lambda e: e["label"])
    cats = F.transform("ranked", lambda e: category(e["label"]))
    r = (pred.withColumn("ranked", ranked_labels())
         .select("doc_id", "true_label", labels.alias("labels"), cats.alias("cats"), category("true_label").alias("cat"))
         .select("doc_id", "true_label",
                 F.coalesce(F.array_position("labels", F.col("true_label")), F.lit(0)).alias("at"),
                 F.coalesce(F.array_position("cats", F.col("cat")), F.lit(0)).alias("first"),
                 (F.size("cats") + 1 - F.array_position(F.reverse("cats"), F.col("cat"))).alias("last")))
    hit = lambda c, n: F.col(c).between(1, n).cast("int")
    w_rank = F.when(F.col("first") > 0, F.col("last" if mode == "reference" else "first"))
    return r.select("doc_id", "true_label", hit("at", 1).alias("correct_label"), hit("at", top_n).alias("top_n_label"),
                    hit("first", 1).alias("correct_category"), hit("first", top_n).alias("top_n_category"),
                    F.coalesce(F.lit(1.0) / w_rank, F.lit(0.0)).alias("weighted_category_score"))


def skip_flags(docs: DataFrame, text_col: str = "text", min_chars: int = K.MIN_TEXT_CHARS) -> DataFrame:
    """keep every document, flag the too-short ones as skipped."""
    return docs.withColumn("skipped", F.when(F.length(text_col) < min_chars, 1).otherwise(0))


def label_results(ind: DataFrame, skipped: DataFrame) -> DataFrame:
    """Counters per true label; skipped documents count only as
    ``skipped`` and not in ``label_count``.
    ``ind``: doc indicators (non-skipped docs); ``skipped``: (doc_id, true_label, skipped)."""
    s = skipped.select("doc_id", "true_label", "skipped")
    j = s.join(ind.drop("true_label"), "doc_id", "left")
    z = lambda c: F.when(F.col("skipped") == 0, F.coalesce(F.col(c), F.lit(0)))
    return j.groupBy(F.col("true_label").alias("label")).agg(
        *[F.coalesce(F.sum(z(c)), F.lit(0)).cast("long").alias(c) for c in COUNTERS],
        F.coalesce(F.sum(z("weighted_category_score")), F.lit(0.0)).alias("weighted_category_score"),
        F.sum("skipped").cast("long").alias("skipped"),
        F.sum(1 - F.col("skipped")).cast("long").alias("label_count"))


def total_results(per_label: DataFrame) -> DataFrame:
    """Sums over labels; ``total_items`` = sum of label counts."""
    return per_label.agg(
        *[F.sum(c).cast("long").alias(c) for c in COUNTERS],
        F.sum("weighted_category_score").alias("weighted_category_score"),
        F.sum("skipped").cast("long").alias("skipped"),
        F.sum("label_count").cast("long").alias("total_items"))


def label_report(per_label: DataFrame, mode: str = "reference") -> DataFrame:
    """A09 + A12: per-label percentages (denominator = label count, or 1),
    sorted by label. In reference mode the 'correct category' column
    repeats the correct-label figure, as the reference prints it."""
    n = F.col("label_count")
    cat_src = "correct_label" if mode == "reference" else "correct_category"
    return per_label.select(
        "label",
        percentage("correct_label", n).alias("pct_correct_label"),
        percentage("top_n_label", n).alias("pct_top_n_label"),
        percentage(cat_src, n).alias("pct_correct_category"),
        percentage("top_n_category", n).alias("pct_top_n_category"),
        F.round("weighted_category_score", 2).alias("weighted_category_score"),
        "label_count").orderBy("label")


def total_report(totals: DataFrame, mode: str = "reference") -> DataFrame:
    """A09 totals block. The weighted category score is the sum over all
    documents (``reference``) or its mean per tested document (``clean``),
    rounded to 3."""
    n = F.col("total_items")
    w = F.col("weighted_category_score")
    if mode == "clean":
        w = F.when(n > 0, w / n).otherwise(F.lit(0.0))
    return totals.select(
        "total_items", "skipped",
        percentage("correct_label", n).alias("pct_correct_label"),
        percentage("top_n_label", n).alias("pct_top_n_label"),
        percentage("correct_category", n).alias("pct_correct_category"),
        percentage("top_n_category", n).alias("pct_top_n_category"),
        F.round(w, 3).alias("weighted_category_score"))


def evaluate(docs: DataFrame, pred: DataFrame, top_n: int = K.TOP_N,
             min_chars: int = K.MIN_TEXT_CHARS, mode: str = "reference") -> tuple[DataFrame, DataFrame]:
    """Docs (doc_id, true_label, text) x predictions -> (per label, totals)."""
    flags = skip_flags(docs, "text", min_chars)
    live = pred.join(flags.filter("skipped = 0").select("doc_id"), "doc_id", "left_semi")
    ind = doc_indicators(live, top_n, mode)
    per = label_results(ind, flags)
    return per, total_results(per)


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def multilabel_scores(pred: DataFrame, threshold: float = K.DECISION_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """A10: thresholded multilabel P/R/F per label, micro and macro.
    ``pred``: (doc_id, true_label, label, score); gold = label == true_label."""
    x = pred.select("label", (F.col("score") >= threshold).alias("p"),
                    (F.col("label") == F.col("true_label")).alias("g"))
    per = x.groupBy("label").agg(
        F.sum((F.col("p") & F.col("g")).cast("long")).alias("tp"),
        F.sum((F.col("p") & ~F.col("g")).cast("long")).alias("fp"),
        F.sum((~F.col("p") & F.col("g")).cast("long")).alias("fn"))
    per = (per.withColumn("p", _safe_div(F.col("tp"), F.col("tp") + F.col("fp")))
              .withColumn("r", _safe_div(F.col("tp"), F.col("tp") + F.col("fn")))
              .withColumn("f", _safe_div(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))))
    tot = per.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                  F.avg("p").alias("macro_p"), F.avg("r").alias("macro_r"), F.avg("f").alias("macro_f"))
    tot = (tot.withColumn("micro_p", _safe_div(F.col("tp"), F.col("tp") + F.col("fp")))
              .withColumn("micro_r", _safe_div(F.col("tp"), F.col("tp") + F.col("fn")))
              .withColumn("micro_f", _safe_div(2 * F.col("micro_p") * F.col("micro_r"),
                                               F.col("micro_p") + F.col("micro_r"))))
    return per, tot


def score_bin(score: Column | str = "score", bins: int = 4096) -> Column:
    """The histogram bin (0 to ``bins - 1``) of a score, of equal width
    on the logit scale between -40 and 40, so that scores near 0 and near 1
    are told apart. Null, 0 and less fall in the first bin, 1, more and NaN in the
    last. The bin never falls as the score rises, which is all the exact ranks need."""
    s = (F.col(score) if isinstance(score, str) else score).cast("double")
    at = F.floor((F.ln(s / (1 - s)) + 40) * ((bins - 2) / 80.0)) + 1
    return (F.when(s.isNull() | (s <= 0), F.lit(0)).when(F.isnan(s) | (s >= 1), F.lit(bins - 1))
            .otherwise(F.greatest(F.lit(1), F.least(F.lit(bins - 2), at))).cast("int"))


def score_histogram(pred: DataFrame, bins: int = 4096) -> DataFrame:
    """Positives and negatives per label and score bin, at most labels x
    ``bins`` rows however many documents there are, as a stored table."""
    g = F.coalesce((F.col("label") == F.col("true_label")).cast("long"), F.lit(0))
    return staged(pred.groupBy("label", score_bin("score", bins).alias("bin"))
                  .agg(F.sum(g).alias("npos"), F.sum(1 - g).alias("nneg")), "score_histogram")


def tied_scores(pred: DataFrame, histogram: DataFrame, bins: int = 4096) -> DataFrame:
    """Positives and negatives per distinct score in the bins that hold
    both, as a stored table. In every other bin the histogram alone decides, so
    only these rows of documents x labels are shuffled."""
    both = broadcast_if_small(histogram.where("npos > 0 AND nneg > 0").select(F.col("label").alias("_label"), F.col("bin").alias("_bin")))
    g = F.coalesce((F.col("label") == F.col("true_label")).cast("long"), F.lit(0))
    rows = (pred.select("label", score_bin("score", bins).alias("bin"), "score", g.alias("g"))
            .join(both, F.col("label").eqNullSafe(F.col("_label")) & (F.col("bin") == F.col("_bin")), "left_semi"))
    return staged(rows.groupBy("label", "bin", "score").agg(F.sum("g").alias("npos"), F.sum(1 - F.col("g")).alias("nneg")), "tied_scores")


def label_auc(pred: DataFrame, bins: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Exact AUC per label (ties count half), and the macro AUC over
    labels that have both classes. ``pred``: (doc_id, true_label, label, score).

    A positive beats the negatives of the lower bins, by the histogram; inside
    a bin of both kinds it is ranked by its score (``prefix_rank``, a bin may
    hold any share of the rows). A null true label is a negative everywhere; a
    null score is the lowest, NaN the highest. ``bins`` changes no result."""
    histogram = score_histogram(pred, bins)
    below = Window.partitionBy("label").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    twice = lambda neg, same: F.col("npos").cast("double") * (2.0 * F.coalesce(neg, F.lit(0)) + same)
    across = histogram.select("label", "npos", "nneg", twice(F.sum("nneg").over(below), F.lit(0)).alias("wins"))
    tied = tied_scores(pred, histogram, bins)
    # slices of about 8 MB of the stored table, so that a few scores need no quantiles
    slices = min(1 + planned_bytes(tied) // (8 << 20), max(64, int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    ranked = prefix_rank(tied, ["label", "bin"], "score", value="nneg", rank_col="_k", before_col="below", n_buckets=slices)
    inside = ranked.select("label", F.lit(0).cast("long").alias("npos"), F.lit(0).cast("long").alias("nneg"),
                           twice(F.col("below"), F.col("nneg")).alias("wins"))
    per = across.unionByName(inside).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("npos", "nneg", "wins")])
    per = per.select("label", "npos", "nneg", F.when((F.col("npos") > 0) & (F.col("nneg") > 0),
                                                     F.col("wins") / (2.0 * F.col("npos") * F.col("nneg"))).alias("auc"))
    return per, per.agg(F.avg("auc").alias("macro_auc"))
