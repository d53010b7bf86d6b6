"""Classification with MLlib: M02-M09, M11.

Hashed bag-of-words (unigrams by default, 2^18 buckets), optional
mean-pooled word vectors, a multinomial linear model, dev-set model
selection, batch scoring into a ``{code: score}`` map and the long form the
evaluation operators consume.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .. import constants as K
from ..session import staged
from .ordered import planned_bytes, spread_small
from .skipgram import WordVectors
from .vectors import CHUNK, encoded, met, numbered, packed, slices, unpacked, whole

NUM_FEATURES = 262144          # 2^18 hash buckets
TOKEN_PATTERN = r"(?U)\w+"
TERMS_AT_ONCE = 1 << 18        # tokens that a worker counts at a time


def tokenizer(input_col: str = "text", output_col: str = "tokens") -> RegexTokenizer:
    """Unicode word tokens, lower-cased."""
    return RegexTokenizer(inputCol=input_col, outputCol=output_col, pattern=TOKEN_PATTERN, gaps=False,
                          toLowercase=True, minTokenLength=1)


def tokenize(df: DataFrame, text_col: str = "text") -> DataFrame:
    return tokenizer(text_col).transform(spread_small(df)).withColumn("n_tokens", F.size("tokens").cast("long"))


def bow_stages(ngram: int = 1, num_features: int = NUM_FEATURES, tokens: str = "tokens",
               out: str = "bow") -> list:
    """N-grams (1 = unigrams) hashed into ``num_features`` buckets."""
    if ngram == 1:
        return [HashingTF(inputCol=tokens, outputCol=out, numFeatures=num_features)]
    return [NGram(n=ngram, inputCol=tokens, outputCol="_ngrams"),
            HashingTF(inputCol="_ngrams", outputCol=out, numFeatures=num_features)]


def word_vector_stage(size: int = 50, tokens: str = "tokens", out: str = "wvec", seed: int = 7,
                      partitions: int = 1) -> WordVectors:
    """Mean-pooled word vectors, skip-gram with hierarchical softmax, of the words that come twice. They are
    trained in ``partitions`` tasks, or more where those would be large, and the tasks' vectors averaged.
    Neither vocabulary nor vectors pass the driver."""
    return WordVectors(size, tokens, out, min_count=2, seed=seed, partitions=partitions)


def training_partitions(df: DataFrame, bytes_each: int = 64 << 20) -> int:
    """Tasks to train in: one for each ``bytes_each`` of the planned input, at
    most the session's shuffle partitions."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, planned_bytes(df) // bytes_each))


def dealt_for_passes(df: DataFrame) -> DataFrame:
    """``df`` in at most as many partitions as there are cores: a pass of the
    optimiser shuffles a whole gradient per task, however few rows it has."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def term_counts(docs: DataFrame, id_col: str = "doc_id", most: int = TERMS_AT_ONCE) -> DataFrame:
    """(id, n_tokens, token, tf): every row's distinct tokens, counted where the
    row is, without a shuffle; null tokens are left out. A worker counts rows of
    about ``most`` tokens at a time."""
    rows = docs.select(id_col, F.col("n_tokens").cast("long").alias("n_tokens"), "tokens")
    out = T.StructType([rows.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("token", T.StringType()),
                        T.StructField("tf", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(2)), 0), dtype=np.int64))
            first = 0
            while first < batch.num_rows:
                before = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
                b = batch.slice(first, last - first)
                first = last
                found = b.column(2).flatten().dictionary_encode()
                held = np.asarray(found.indices.is_valid())
                at = np.asarray(pc.list_parent_indices(b.column(2)), dtype=np.int64)[held]
                words = len(found.dictionary)
                key, tf = np.unique(at * words + np.asarray(found.indices.drop_null(), dtype=np.int64), return_counts=True)
                row, word = pa.array(key // max(words, 1)), pa.array(key % max(words, 1))
                yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), found.dictionary.take(word),
                                                  pa.array(tf, pa.int64())], names=out.names)
    return rows.mapInArrow(run, out)


def mean_vectors(docs: DataFrame, vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """M04 by a given table of (token, vector): the mean over a document's
    tokens (unknown tokens count as zero, as Word2Vec's transform does).
    Token counts are summed per row before the join, and components per
    document after it, so neither a frequent token nor a long text is one task."""
    terms = term_counts(docs, id_col)
    parts = (terms.join(vectors, "token").select(id_col, "n_tokens", "tf", F.posexplode("vector").alias("pos", "x"))
             .groupBy(id_col, "pos").agg((F.sum(F.col("tf") * F.col("x")) / F.max("n_tokens")).alias("x")))
    return parts


def mean_long_vectors(docs: DataFrame, vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``mean_vectors`` for vectors of many numbers, all of one length: chunks of
    many rows meet the vectors of their distinct tokens and add up there, so no
    term is shuffled, nor its vector's numbers. Short vectors are joined faster by ``mean_vectors``."""
    vectors = vectors.where("token IS NOT NULL AND vector IS NOT NULL").select(F.col("token").alias("word"), "vector")
    terms = term_counts(docs, id_col)
    kind = terms.schema[id_col].dataType
    out = f"id {kind.simpleString()}, n_tokens long, vector array<double>"
    id_type = to_arrow_type(kind)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbered()
        for held in slices(batches, CHUNK):
            t = pa.Table.from_batches(held).combine_chunks()
            words, codes = encoded(whole(t.column("token")))
            ids = whole(t.column(id_col)).dictionary_encode("encode")
            key = np.stack([np.asarray(ids.indices, dtype=np.int64), np.asarray(t.column("n_tokens"), dtype=np.int64)])
            new = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
            first = pa.array(np.flatnonzero(new))
            made = {"chunk": pa.array([next(number)], pa.int64()), "words": pa.array([words], pa.list_(pa.string())),
                    "ids": pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), ids.dictionary.take(ids.indices.take(first))),
                    "sizes": pa.array([key[1][new]], pa.list_(pa.int64())), "terms": pa.array([len(codes)], pa.int64()),
                    "codes": pa.array([packed(codes)], pa.binary()), "rows": pa.array([packed(np.diff(np.cumsum(new), prepend=1).astype(np.int8))], pa.binary()),
                    "tf": pa.array([packed(np.asarray(t.column("tf"), dtype=np.int64))], pa.binary())}
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    def mean(row: dict, found: pa.Table) -> pa.Table:
        words, n = row["words"].values, row["terms"].as_py()
        at = unpacked(row["codes"].as_py(), np.int32, n)
        doc = np.cumsum(unpacked(row["rows"].as_py(), np.int8, n), dtype=np.int64)
        place = np.asarray(pc.index_in(whole(found.column("word")), value_set=words))
        given = whole(found.column("vector"))
        width = len(given[0]) if found.num_rows else 0
        held, known = np.zeros((len(words), width)), np.zeros(len(words), bool)
        if found.num_rows:
            np.add.at(held, place, np.asarray(given.flatten(), dtype=np.float64).reshape(-1, width))
            known[place] = True
        some = known[at]
        docs, first = np.unique(doc[some], return_index=True)
        tf = unpacked(row["tf"].as_py(), np.int64, n)[some]
        sums = (np.stack([np.add.reduceat(tf * held[at[some], j], first) for j in range(width)], axis=1) if len(first) and width
                else np.zeros((len(docs), width)))
        return pa.table({"id": row["ids"].values.take(pa.array(docs)).cast(id_type), "n_tokens": row["sizes"].values.take(pa.array(docs)),
                         "vector": pa.array(list(sums), pa.list_(pa.float64()))})
    chunks = staged(terms.mapInArrow(chunked, T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("ids", T.ArrayType(kind)),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("terms", T.LongType()),
        *[T.StructField(c, T.BinaryType()) for c in ("codes", "rows", "tf")]])), "term-chunks")
    return (met(chunks, "chunk", vectors, mean, out).select(F.col("id").alias(id_col), "n_tokens", F.posexplode("vector").alias("pos", "x"))
            .groupBy(id_col, "pos").agg((F.sum("x") / F.max("n_tokens")).alias("x")))


def classifier_pipeline(ensemble: bool = False, reg: float = 0.0, ngram: int = 1,
                        max_iter: int = 20, label_col: str = "true_label", num_features: int = NUM_FEATURES,
                        partitions: int = 1, aggregation_depth: int = 2) -> Pipeline:
    """Exclusive-class linear model over hashed BOW. With
    ``ensemble`` a second linear model over mean-pooled word vectors is fit
    in the same pipeline and ``score`` averages the two probability
    vectors. The model is a dense ``num_features`` x classes matrix on the
    driver: choose ``num_features`` (and ``aggregation_depth``) to its memory
    when there are many classes."""
    stages = [StringIndexer(inputCol=label_col, outputCol="y", stringOrderType="alphabetAsc",
                            handleInvalid="keep"),
              tokenizer()]
    if not ensemble:
        stages += bow_stages(ngram, num_features)
        stages.append(LogisticRegression(featuresCol="bow", labelCol="y", family="multinomial",
                                         regParam=reg, maxIter=max_iter,
                                         aggregationDepth=aggregation_depth))
        return Pipeline(stages=stages)
    # the hashed words' model needs no word vectors, so it is fit before rows meet theirs
    stages += [*bow_stages(ngram, num_features),
               LogisticRegression(featuresCol="bow", labelCol="y", family="multinomial", regParam=reg,
                                  maxIter=max_iter, aggregationDepth=aggregation_depth, probabilityCol="p_bow", rawPredictionCol="r_bow",
                                  predictionCol="y_bow"),
               word_vector_stage(partitions=partitions),
               LogisticRegression(featuresCol="wvec", labelCol="y", family="multinomial", regParam=reg,
                                  maxIter=max_iter, aggregationDepth=aggregation_depth, probabilityCol="p_vec", rawPredictionCol="r_vec",
                                  predictionCol="y_vec")]
    return Pipeline(stages=stages)


def labels_of(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def score(model: PipelineModel, docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every document -> ``scores`` map {code: probability}."""
    keep = keep or [c for c in docs.columns if c != "text"]
    labels = F.array(*[F.lit(x) for x in labels_of(model)])
    out = model.transform(spread_small(docs))
    if "p_bow" in out.columns:      # ensemble: mean of the two probability vectors
        probs = F.zip_with(vector_to_array("p_bow"), vector_to_array("p_vec"), lambda a, b: (a + b) / 2)
    else:
        probs = vector_to_array("probability")
    return out.select(*keep, F.map_from_arrays(labels, F.slice(probs, 1, len(labels_of(model)))).alias("scores"))


def scored_rows(scored: DataFrame, model: PipelineModel) -> DataFrame:
    """M08 as the evaluation takes it: the map as an array ``scored`` of
    (label, label_pos, score); the position is the code's place in the label list."""
    entries = [F.struct(F.lit(c).alias("label"), F.lit(i).alias("label_pos"), F.col("scores")[c].alias("score"))
               for i, c in enumerate(labels_of(model))]
    return scored.select(*[c for c in scored.columns if c != "scores"], F.array(*entries).alias("scored"))


def long_scores(scored: DataFrame, model: PipelineModel) -> DataFrame:
    """M08 long form ``(doc_id, true_label, label, score, label_pos)``; the
    label position is the code's place in the sorted label list."""
    labels = labels_of(model)
    pos = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.lit(i))])
    ex = scored.select(*[c for c in scored.columns if c != "scores"], F.explode("scores").alias("label", "score"))
    return ex.withColumn("label_pos", pos[F.col("label")])


def threshold_labels(scores_col: str = "scores", threshold: float = K.DECISION_THRESHOLD):
    """Multilabel prediction = codes whose score reaches the threshold."""
    return F.map_filter(F.col(scores_col), lambda k, v: v >= threshold)


def accuracy(scored: DataFrame) -> DataFrame:
    best = F.get(F.array_sort(F.transform(F.map_entries("scores"),
                                          lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("k")))), 0)["k"]
    return scored.agg(F.avg((best == F.col("true_label")).cast("double")).alias("accuracy"),
                      F.count(F.lit(1)).alias("n"))


def select_model(train: DataFrame, dev: DataFrame, grid: list[dict]) -> tuple[PipelineModel, DataFrame]:
    """Fit each grid point on ``train``, score on the fixed ``dev`` set
    by macro F (threshold scorer), keep the best. Returns the model and a
    table of (params, dev score)."""
    from .evaluate import multilabel_scores
    train, dev = (staged(d.select("doc_id", "true_label", "text"), "features") for d in (train, dev))  # read once per grid point
    train = dealt_for_passes(train)
    rows = []
    best = None
    for i, params in enumerate(grid):
        model = classifier_pipeline(**params).fit(train)
        pred = long_scores(score(model, dev, ["doc_id", "true_label"]), model)
        _, tot = multilabel_scores(pred)
        f = tot.first()["macro_f"]
        rows.append((i, str(sorted(params.items())), float(f)))
        if best is None or f > best[1]:
            best = (model, f)
    spark = train.sparkSession
    table = spark.createDataFrame(rows, "grid_id int, params string, dev_macro_f double")
    return best[0], table
