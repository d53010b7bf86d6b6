"""Queries for the MLlib jobs M02-M09, M11 (rows-only: scores of a trained
model have no portable oracle; M02 token counts do)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dataset as D
from ..operators import evaluate as V
from ..operators import learn as L
from ..operators import sharded as S
from ..operators import vectors as W
from ..session import staged
from ..sources import fixtures as fx
from .registry import query


def _split_docs(spark, sf):
    d = fx.v_labelled_docs(spark, sf).select("doc_id", "true_label", "text")
    return D.split_by_rank(d, "true_label", "doc_id")


def _trained(spark, sf, ensemble=False):
    s = _split_docs(spark, sf)
    if ensemble:        # read by every model and by the word vectors: ranked once, not a shuffle of all texts each time
        s = staged(s, "split-docs", lean=True)
    train = s.filter(F.col("split") == "train")
    if ensemble:
        train = L.dealt_for_passes(train)
    model = L.classifier_pipeline(ensemble=ensemble, partitions=L.training_partitions(train)).fit(train)
    return model, s


@query("m02_tokenise",
       "SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\\pL\\pM\\p{Nd}_]+', 0)) AS BIGINT) AS n_tokens FROM documents")
def m02(spark, sf):
    from ..sources.tables import table
    return L.tokenize(table(spark, sf, "documents")).select("doc_id", "n_tokens")


@query("m03_hashed_bow")
def m03(spark, sf):
    d = L.tokenize(fx.v_labelled_docs(spark, sf))
    for st in L.bow_stages(1):
        d = st.transform(d)
    # plain columns only: the sparse vector as text gives its bucket list
    vec = F.col("bow").cast("string")
    buckets = F.regexp_extract(vec, r"^\(\d+,\[([^\]]*)\]", 1)
    n_buckets = F.when(buckets == "", F.lit(0)).otherwise(F.size(F.split(buckets, ",")))
    return d.select("doc_id", "n_tokens", F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"),
                    n_buckets.cast("long").alias("n_buckets"), F.md5(vec).alias("bow_md5"))


@query("m04_mean_word_vectors")
def m04(spark, sf):
    d = L.tokenize(fx.v_labelled_docs(spark, sf)).select("doc_id", "tokens")
    model = L.word_vector_stage(size=20, partitions=L.training_partitions(d)).fit(d)
    from pyspark.ml.functions import vector_to_array
    return model.transform(d).select("doc_id", F.size(vector_to_array("wvec")).alias("dims"))


@query("m05_linear_classifier")
def m05(spark, sf):
    model, s = _trained(spark, sf)
    test = s.filter(F.col("split") == "test")
    return L.score(model, test, ["doc_id", "true_label", "split"])


@query("m05_test_accuracy")
def m05a(spark, sf):
    model, s = _trained(spark, sf)
    return L.accuracy(L.score(model, s.filter(F.col("split") == "test"), ["doc_id", "true_label"]))


@query("m06_ensemble_classifier")
def m06(spark, sf):
    model, s = _trained(spark, sf, ensemble=True)
    return L.accuracy(L.score(model, s.filter(F.col("split") == "test"), ["doc_id", "true_label"]))


@query("m07_model_selection")
def m07(spark, sf):
    s = _split_docs(spark, sf)
    _, table = L.select_model(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "dev"),
                              [{"reg": 0.0}, {"reg": 0.01}])
    return table


@query("m08_batch_scores")
def m08(spark, sf):
    model, s = _trained(spark, sf)
    return L.long_scores(L.score(model, s, ["doc_id", "true_label"]), model)


@query("m09_threshold_labels")
def m09(spark, sf):
    model, s = _trained(spark, sf)
    sc = L.score(model, s, ["doc_id", "true_label"])
    return sc.select("doc_id", F.array_sort(F.map_keys(L.threshold_labels())).alias("labels"))


@query("m10_evaluation_with_model")
def m10m(spark, sf):
    model, s = _trained(spark, sf)
    test = s.filter(F.col("split") == "test").withColumn("text", F.concat(F.lit(" "), "text"))
    pred = L.scored_rows(L.score(model, test, ["doc_id", "true_label"]), model)
    per, _ = V.evaluate(test, pred, top_n=5, min_chars=300)
    return V.label_report(per)


@query("m11_predict_pages")
def m11(spark, sf):
    """Pages -> extracted text (body + meta) -> scores -> top 10 with descriptions."""
    model, _ = _trained(spark, sf)
    pages = fx.v_scraped(spark, sf).select("page_id", "url", "raw_html")
    texts = D.extract_pages(pages, filter_=True, keep=["page_id", "url"]).withColumnRenamed("data", "text")
    sc = L.score(model, texts.withColumn("true_label", F.lit(None).cast("string")), ["page_id"])
    rows = L.scored_rows(sc, model).withColumnRenamed("page_id", "doc_id")
    return V.top_labels(rows, fx.v_sni(spark), n=10).select("doc_id", "label", "rank", "score", "description")


@query("m09_threshold_of_scores",
       """SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM v_scores WHERE score >= 0.368 GROUP BY doc_id""")
def m09_given(spark, sf):
    """M09 on given scores: the labels that reach the decision threshold."""
    s = fx.v_score_rows(spark, sf).withColumn("scores", F.map_from_entries(
        F.transform("scored", lambda e: F.struct(e["label"], e["score"]))))
    labels = F.array_sort(F.map_keys(L.threshold_labels()))
    return s.select("doc_id", F.array_join(labels, ",").alias("labels")).where("labels != ''")


TOKENS_SQL = "SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pM\\p{Nd}_]+', 0) AS t FROM v_labelled_docs"


@query("m03_token_counts",
       f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct FROM ({TOKENS_SQL}) x""")
def m03_counts(spark, sf):
    d = L.tokenize(fx.v_labelled_docs(spark, sf))
    return d.select("doc_id", "n_tokens", F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"))


@query("m04_mean_of_given_vectors",
       f"""SELECT doc_id, pos, round(sum(x) / max(n), 6) AS x FROM (
  SELECT doc_id, len(t) AS n, unnest(t) AS token FROM ({TOKENS_SQL}) a) d,
  LATERAL (SELECT unnest([0, 1]) AS pos, unnest([length(token) * 1.0e0, CASE WHEN substring(token, 1, 1) < 'm' THEN 1.0e0 ELSE 0.0e0 END]) AS x) v
GROUP BY doc_id, pos""")
def m04_given(spark, sf):
    """M04 with a given vector per token (its length, and 0 or 1 by its first letter)."""
    d = L.tokenize(fx.v_labelled_docs(spark, sf))
    words = d.select(F.explode("tokens").alias("token")).distinct()
    vectors = words.select("token", F.array(F.length("token").cast("double"), F.when(
        F.substring("token", 1, 1) < "m", F.lit(1.0)).otherwise(0.0)).alias("vector"))
    return L.mean_vectors(d, vectors).select("doc_id", "pos", F.round("x", 6).alias("x"))


@query("m04_ppmi", f"""WITH t AS ({TOKENS_SQL}),
p AS (SELECT t[i] AS a, t[i + d] AS b FROM (SELECT t, unnest(range(1, len(t))) AS i FROM t) x, (SELECT unnest([1, 2]) AS d) y WHERE i + d <= len(t)),
c AS (SELECT word, context, sum(n) AS n FROM (SELECT a AS word, b AS context, count(*) AS n FROM p GROUP BY ALL
      UNION ALL SELECT b, a, count(*) FROM p GROUP BY ALL) u GROUP BY ALL),
s AS (SELECT word, sum(n) AS n FROM c GROUP BY ALL)
SELECT c.word, c.context, round(ln(c.n * (SELECT sum(n) FROM s) / (w.n * 1.0e0 * k.n)), 6) AS value
FROM c JOIN s w ON w.word = c.word JOIN s k ON k.word = c.context WHERE ln(c.n * (SELECT sum(n) FROM s) / (w.n * 1.0e0 * k.n)) > 1e-9""")
def m04_ppmi(spark, sf):
    """The matrix that the word vectors factorise, over all documents and words."""
    d = L.tokenize(fx.v_labelled_docs(spark, sf))
    return W.mirrored(W.ppmi(W.pair_counts(d)), "value").where("value > 1e-9").select("word", "context", F.round("value", 6).alias("value"))


@query("m04_factorised_vectors")
def m04_factorised(spark, sf):
    """Mean of the factorised word vectors per document, in long form."""
    d = staged(L.tokenize(fx.v_labelled_docs(spark, sf)).select("doc_id", "n_tokens", "tokens"), "tokens")
    vectors, _ = W.factorised(W.ppmi(W.pair_counts(d, min_count=2)), size=16, oversample=4, rounds=2)
    return L.mean_long_vectors(d, vectors.withColumnRenamed("word", "token"))


BUCKETS, REGS, ROUNDS = 64, (0.001, 0.05), 3


def _softmax_rounds(source: str, rounds: int = ROUNDS, beside: str = "", extra: int = 0) -> str:
    """CTEs of the training rounds in SQL: w1, w2, ... hold (model, f, label, w, u), u the point of the next gradient, over all rows of ``source``.
    ``beside``: rows (doc_id, f, x) of ``extra`` further features."""
    last = BUCKETS + extra
    regs = ", ".join(f"({i}, CAST({r!r} AS DOUBLE))" for i, r in enumerate(REGS))
    out = f"""t AS (SELECT doc_id, true_label, unnest(regexp_extract_all(lower(text), '[\\pL\\pM\\p{{Nd}}_]+', 0)) AS token FROM {source}),
c AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {BUCKETS} AS INT) AS f, count(*) AS k FROM t GROUP BY ALL),
x AS (SELECT doc_id, f, k / sqrt(sum(k * k) OVER (PARTITION BY doc_id)) AS x FROM c UNION ALL SELECT doc_id, {last}, 1.0 FROM {source}{beside}),
s AS (SELECT doc_id, sum(abs(x)) AS s FROM x GROUP BY doc_id),
b AS (SELECT f, sum(abs(x) * s) / 2 AS d FROM x JOIN s USING (doc_id) GROUP BY f),
m AS (SELECT * FROM (VALUES {regs}) AS r(model, reg)),
n AS (SELECT count(*) AS n FROM {source}),
w0 AS (SELECT model, f, label, 0.0e0 AS w, 0.0e0 AS u FROM m, b, (SELECT DISTINCT true_label AS label FROM {source}) l)"""
    for k in range(1, rounds + 1):
        out += f""",
z{k} AS (SELECT model, doc_id, label, sum(x * u) AS z FROM x JOIN w{k - 1} USING (f) GROUP BY ALL),
p{k} AS (SELECT model, doc_id, label, exp(z) / sum(exp(z)) OVER (PARTITION BY model, doc_id) AS p FROM z{k}),
g{k} AS (SELECT model, f, label, sum(x * (p - CASE WHEN label = true_label THEN 1 ELSE 0 END)) AS g
         FROM x JOIN p{k} USING (doc_id) JOIN {source} USING (doc_id) GROUP BY ALL),
h{k} AS (SELECT model, f, label, w, u - (g / n + CASE WHEN f = {last} THEN 0 ELSE reg END * u)
                / (d / n + CASE WHEN f = {last} THEN 0 ELSE reg END) AS v
         FROM w{k - 1} JOIN g{k} USING (model, f, label) JOIN b USING (f) JOIN m USING (model), n),
w{k} AS (SELECT model, f, label, v AS w, v + {S._momentum(k)!r} * (v - w) AS u FROM h{k})"""
    return out


def _scores_sql(k: int, source: str) -> str:
    return f"""SELECT model, doc_id, label, exp(z) / sum(exp(z)) OVER (PARTITION BY model, doc_id) AS p
FROM (SELECT model, doc_id, label, sum(x * w) AS z FROM {source} JOIN w{k} USING (f) GROUP BY ALL) y"""


def _sharded(spark, sf):
    d = fx.v_labelled_docs(spark, sf).select("doc_id", "true_label", "text")
    return d, S.train(d, ROUNDS, regs=REGS, buckets=BUCKETS, span=16, width=2)


@query("m05_sharded_weights", f"""WITH {_softmax_rounds("v_labelled_docs")}
SELECT model, f AS feature, label, round(w, 6) AS w FROM w{ROUNDS} WHERE round(w, 6) <> 0""")
def m05_sharded(spark, sf):
    """M05 by the sharded learner: a grid of two models, their coefficients after three rounds."""
    _, model = _sharded(spark, sf)
    return S.weights(model).select("model", "feature", "label", F.round("w", 6).alias("w")).where("w <> 0")


@query("m08_sharded_scores", f"""WITH {_softmax_rounds("v_labelled_docs")}
SELECT model, doc_id, label, round(p, 6) AS score FROM ({_scores_sql(ROUNDS, "x")}) q""")
def m08_sharded(spark, sf):
    """M08 by the sharded learner: every document's probability of every code."""
    d, model = _sharded(spark, sf)
    return (S.score_map(model, S.probabilities(model, d.select("doc_id", "text")))
            .select("model", "doc_id", F.explode("scores").alias("label", "score")).withColumn("score", F.round("score", 6)))


#: Two numbers per token, of either sign, for the joint model: its length against six, its first letter's half.
TOKEN_VECTOR_SQL = "[(length(token) - 6) / 10.0e0, CASE WHEN substring(token, 1, 1) < 'm' THEN 0.5e0 ELSE -0.5e0 END]"
JOINT_SQL = _softmax_rounds("v_labelled_docs", beside=f"""
  UNION ALL SELECT doc_id, {BUCKETS} + pos, coalesce(x, 0) FROM (SELECT doc_id, pos, sum(v[pos + 1]) / count(*) AS x
    FROM (SELECT doc_id, {TOKEN_VECTOR_SQL} AS v FROM t) y, (SELECT unnest([0, 1]) AS pos) z GROUP BY doc_id, pos) q""", extra=2)


def _joint(spark, sf):
    d = L.tokenize(fx.v_labelled_docs(spark, sf)).select("doc_id", "true_label", "text", "tokens")
    mean = lambda number: F.when(F.size("tokens") > 0, F.aggregate(
        "tokens", F.lit(0.0), lambda a, t: a + number(t)) / F.size("tokens")).otherwise(0.0)
    d = d.withColumn("vector", F.array(mean(lambda t: (F.length(t) - 6) / 10.0),
                                       mean(lambda t: F.when(F.substring(t, 1, 1) < "m", 0.5).otherwise(-0.5)))).drop("tokens")
    return d, S.train(d, ROUNDS, regs=REGS, buckets=BUCKETS, span=16, width=2, vector_col="vector", vector_size=2)


@query("m06_joint_weights", f"""WITH {JOINT_SQL}
SELECT model, f AS feature, label, round(w, 6) AS w FROM w{ROUNDS} WHERE round(w, 6) <> 0""")
def m06_joint(spark, sf):
    """M06 over joint features: one model of the hashed words and the mean vector of the document's tokens."""
    _, model = _joint(spark, sf)
    return S.weights(model).select("model", "feature", "label", F.round("w", 6).alias("w")).where("w <> 0")


@query("m06_joint_scores", f"""WITH {JOINT_SQL}
SELECT model, doc_id, label, round(p, 6) AS score FROM ({_scores_sql(ROUNDS, "x")}) q""")
def m06_joint_scores(spark, sf):
    """Every document's probability of every code by the joint model."""
    d, model = _joint(spark, sf)
    return (S.score_map(model, S.probabilities(model, d, vector_col="vector"))
            .select("model", "doc_id", F.explode("scores").alias("label", "score")).withColumn("score", F.round("score", 6)))


def _checkpoints_sql() -> str:
    checks = " UNION ALL ".join(f"SELECT {k} AS round, * FROM ({_scores_sql(k, 'xd')}) q" for k in range(1, ROUNDS + 1))
    return f"""WITH {_softmax_rounds("v_train")},
td AS (SELECT doc_id, true_label, unnest(regexp_extract_all(lower(text), '[\\pL\\pM\\p{{Nd}}_]+', 0)) AS token FROM v_dev),
cd AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {BUCKETS} AS INT) AS f, count(*) AS k FROM td GROUP BY ALL),
xd AS (SELECT doc_id, f, k / sqrt(sum(k * k) OVER (PARTITION BY doc_id)) AS x FROM cd UNION ALL SELECT doc_id, {BUCKETS}, 1.0 FROM v_dev),
q AS (SELECT u.*, v.true_label, row_number() OVER (PARTITION BY round, model, u.doc_id ORDER BY p DESC, label) AS r
      FROM ({checks}) u JOIN v_dev v ON v.doc_id = u.doc_id),
per AS (SELECT round, model, label, count(*) FILTER (p >= 0.368 AND label = true_label) AS tp, count(*) FILTER (p >= 0.368) AS said,
               count(*) FILTER (label = true_label) AS gold, count(*) FILTER (r = 1 AND label = true_label) AS hit FROM q GROUP BY ALL)
SELECT CAST(round AS INT) AS round, model, reg, round(avg(CASE WHEN said + gold > 0 THEN 2 * tp / (said + gold) ELSE 0 END), 6) AS dev_macro_f,
       round(sum(hit) / sum(gold), 6) AS dev_accuracy FROM per JOIN m USING (model) GROUP BY ALL"""


@query("m07_best_checkpoint", _checkpoints_sql(),
       extra={"v_train": "SELECT * FROM v_labelled_docs WHERE doc_id % 5 <> 0", "v_dev": "SELECT * FROM v_labelled_docs WHERE doc_id % 5 = 0"})
def m07_checkpoints(spark, sf):
    """The grid trained in one pass a round, every checkpoint scored on the dev rows."""
    d = fx.v_labelled_docs(spark, sf).select("doc_id", "true_label", "text")
    _, _, table = S.train_with_dev(d.where("doc_id % 5 <> 0"), d.where("doc_id % 5 = 0"), REGS, ROUNDS, every=1, patience=ROUNDS,
                                   buckets=BUCKETS, span=16, width=2)
    return table.select("round", "model", "reg", F.round("dev_macro_f", 6).alias("dev_macro_f"),
                        F.round("dev_accuracy", 6).alias("dev_accuracy"))
