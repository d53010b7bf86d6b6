"""The stage jobs chained end to end on sf0.001, through Parquet tables."""

import uuid

from pyspark.sql import functions as F

from sectorlens.plans import jobs as J
from sectorlens.session import ensure_checkpoint_dir
from sectorlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_stage_chain(spark):
    base = f"{ensure_checkpoint_dir(spark)}/test-jobs-{uuid.uuid4().hex}"
    comp = fx.v_companies(spark, SF_SMALL)
    comp.write.parquet(f"{base}/register")
    comp.select("legal_form").distinct().write.parquet(f"{base}/forms")
    total = J.sample_job(spark, f"{base}/register", f"{base}/forms", f"{base}/companies", limit=50, seed=None)
    assert total.first()["count"] > 0

    fx.v_hits(spark, SF_SMALL).write.parquet(f"{base}/hits")
    fx.v_sni(spark).write.parquet(f"{base}/codes")
    J.lookup_job(spark, f"{base}/register", f"{base}/hits", f"{base}/codes", f"{base}/companies2", limit=5)
    assert spark.read.parquet(f"{base}/companies2").count() > 0

    J.frontier_job(spark, f"{base}/register", None, f"{base}/frontier")
    assert spark.read.parquet(f"{base}/frontier").count() > 0

    J.lookup_job(spark, f"{base}/register", f"{base}/hits", f"{base}/codes", f"{base}/companies3", limit=5, regenerate=True)
    assert spark.read.parquet(f"{base}/companies3").count() > 0
    start = spark.read.parquet(f"{base}/frontier").first()
    linked = [(start["label"], start["url"], '<a href="/om/oss">o</a><a href="/x">x</a><a href="http://other.dk/om">p</a>')]
    spark.createDataFrame(linked, "label string, url string, raw_html string").write.json(f"{base}/stored")
    J.frontier_job(spark, f"{base}/register", f"{base}/stored", f"{base}/frontier2", follow_links=True)
    urls = {r["url"]: r["depth"] for r in spark.read.parquet(f"{base}/frontier2").collect()}
    assert start["url"] not in urls and [u for u, d in urls.items() if d == 1] == [start["url"].rstrip("/") + "/om/oss"]

    J.sample_job(spark, f"{base}/register", f"{base}/forms", f"{base}/resumed", seed=None, codes_path=f"{base}/codes")
    first = spark.read.parquet(f"{base}/resumed").count()
    J.sample_job(spark, f"{base}/register", f"{base}/forms", f"{base}/resumed", seed=None, codes_path=f"{base}/codes")
    assert 0 < first <= spark.read.parquet(f"{base}/resumed").count()

    pages = fx.v_scraped(spark, SF_SMALL)
    per, tot = J.extract_job(spark, pages, f"{base}/register", f"{base}/extracted", "2024-03-01 00:00:00")
    assert tot.first()["n_urls"] > 0

    J.divide_job(spark, f"{base}/register", f"{base}/extracted", f"{base}/dataset", pct=(50, 25, 25))
    splits = {r["split"] for r in spark.read.parquet(f"{base}/dataset").select("split").distinct().collect()}
    assert "dev" in splits

    stats = J.corpus_job(spark, f"{base}/dataset", f"{base}/corpus", min_chars=150)
    assert stats.filter(F.col("level") == "total").first()["n_docs"] > 0


def test_train_evaluate_predict(spark):
    from sectorlens.operators.dataset import split_by_rank
    base = f"{ensure_checkpoint_dir(spark)}/test-jobs-{uuid.uuid4().hex}"
    docs = split_by_rank(fx.v_labelled_docs(spark, "/root/testdata/sf0.01"), "true_label", "doc_id")
    docs.select(F.col("doc_id").alias("company_id"), "split", F.col("true_label").alias("sni_code"), "text") \
        .write.partitionBy("split").parquet(f"{base}/corpus")
    docs.select(F.col("doc_id").alias("company_id"), F.col("doc_id").alias("seq"), F.col("text").alias("data"),
                F.array("true_label").alias("branch_codes"), "split") \
        .write.partitionBy("split").parquet(f"{base}/dataset")
    table = J.train_job(spark, f"{base}/corpus", f"{base}/model", grid=[{"reg": 0.0}])
    assert table.count() == 1
    report, totals, prf, macro = J.evaluate_job(spark, f"{base}/dataset", f"{base}/model")
    t = totals.first()
    assert t["total_items"] > 0 and t["pct_correct_label"] > 80.0   # language is learnable
    pages = fx.v_scraped(spark, SF_SMALL).select("page_id", "url", "raw_html")
    top = J.predict_job(spark, pages, f"{base}/model", fx.v_sni(spark), n=3)
    assert top.filter("rank <= 3").count() == top.count() > 0


def test_selection_trains_in_no_more_tasks_than_cores(spark, monkeypatch):
    """m07: a pass of the optimiser shuffles a gradient per task, so the training rows' many files are read by few tasks."""
    from sectorlens.operators import learn as L
    cores, seen, real = spark.sparkContext.defaultParallelism, [], L.classifier_pipeline

    class Watched:
        def __init__(self, **params):
            self.pipeline = real(num_features=64, max_iter=2, **params)

        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return self.pipeline.fit(df)
    monkeypatch.setattr(L, "classifier_pipeline", Watched)
    monkeypatch.setattr(L, "staged", lambda df, name: df)
    docs = spark.createDataFrame([(i, "ab"[i % 2], f"{'x y' if i % 2 else 'u v'} w{i}") for i in range(100)], "doc_id long, true_label string, text string")
    _, table = L.select_model(docs.repartition(5 * cores), docs, [{"reg": 0.0}])
    assert seen == [(cores, 100)] and table.count() == 1
