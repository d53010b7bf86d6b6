"""End-to-end jobs: one per stage of the reference's workflow, table in,
table out (Parquet paths, ideally in a shared file system).

    sample    register -> sampled companies            (A05, W05)
    lookup    companies x search hits -> urls          (W03, J08, J10)
    frontier  companies x stored pages -> urls to fetch (P06, J04, H14)
    extract   pages x companies -> extracted pages     (H15, A03)
    divide    companies x extracted -> split dataset   (W01, W02, S06)
    corpus    dataset -> corpora                       (M01, S07, A04)
    train     corpora -> model                         (M02-M07)
    evaluate  dataset(test) x model -> reports         (M10, A07-A11)
    predict   pages x model -> top-10 codes            (M11)
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import crawl as C
from ..operators import dataset as D
from ..operators import enrich as N
from ..operators import evaluate as V
from ..operators import html as H
from ..operators import learn as L
from ..operators import registry as R
from ..operators import sampling as S
from ..session import staged
from ..sources import tables as T


def sample_job(spark: SparkSession, register_path: str, legal_forms_path: str, out_path: str,
               limit: int = K.FETCH_LIMIT, seed: int | None = 42, codes_path: str | None = None,
               raw: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Budgeted sample of the register per code; appends to ``out_path``.

    ``raw`` registers are normalised first (P01; ``keep`` fields are carried).
    With ``codes_path`` (included codes) only codes of the configured range
    are visited, after the last code that ``out_path`` already holds (W06,
    F21, T01). Inactive and unregistered companies never count (F10).
    """
    reg = spark.read.parquet(register_path)
    if raw:
        reg = R.normalise_register(reg, keep)
    forms = spark.read.parquet(legal_forms_path)
    counts = S.counts_by_code_and_municipality(reg, forms)
    if codes_path is not None:
        last = None
        if T.path_exists(spark, out_path):
            last = S.last_code(spark.read.parquet(out_path)).first()["last_code"]  # one value
        codes = S.code_range(spark.read.parquet(codes_path).select("sni_code"), last)
        counts = counts.join(codes, "sni_code", "left_semi")
    sel = S.budgeted_selection(counts, limit, seed)
    picked = S.sampled_companies(reg, sel).drop("sni_code")
    picked.write.mode("append").parquet(out_path)
    return S.fetched_total(sel)


def lookup_job(spark: SparkSession, companies_path: str, hits_path: str, codes_path: str,
               out_path: str, limit: int = K.LOOKUPS_PER_CODE, regenerate: bool = False) -> None:
    """Companies get the first search hit as url (or are removed). With
    ``regenerate`` those with a url are looked up again, and whoever got one
    counts again for its later codes."""
    comp, hits = spark.read.parquet(companies_path), spark.read.parquet(hits_path)
    codes = spark.read.parquet(codes_path).select("sni_code")
    if regenerate:
        processed = N.serial_code_quota(comp, codes, limit, has_url="BOTH", staying=N.successful_lookups(comp, hits))
    else:
        processed = N.serial_code_quota(comp, codes, limit, has_url="NO")
    N.apply_lookup_results(comp, processed, hits) \
        .write.mode("overwrite").parquet(out_path)


def frontier_job(spark: SparkSession, companies_path: str, stored_pages_path: str | None,
                 out_path: str, filter_: bool = True, mode: str = "reference", follow_links: bool = False) -> None:
    """Urls still to fetch: start urls minus stored ones (stop-listed dropped).

    With ``follow_links`` the stored start pages are parsed and their links of
    the same site join the frontier one level deeper (H14).
    """
    seed = C.start_urls(spark.read.parquet(companies_path))
    stored = (T.scraped_urls(spark, stored_pages_path) if stored_pages_path
              else spark.createDataFrame([], "url string"))
    if follow_links and stored_pages_path:
        pages = T.read_page_dump(spark, stored_pages_path).join(seed.select("url").distinct(), "url", "left_semi")
        linked = H.parse_pages(pages, html_col="raw_html", keep=["label", "url"], with_links=True, parts=()) \
            .filter("ok").withColumn("depth", F.lit(0))
        C.next_frontier(seed, linked, stored, filter_, mode).write.mode("overwrite").parquet(out_path)
        return
    if filter_:
        seed = seed.filter(~C.stop_listed("url", mode))
    C.unscraped(seed, stored).write.mode("overwrite").parquet(out_path)


def extract_job(spark: SparkSession, pages: DataFrame, companies_path: str, out_path: str,
                run_ts: str, extract_meta: bool = True, extract_body: bool = True,
                p_only: bool = False, seq_col: str = "page_id") -> tuple[DataFrame, DataFrame]:
    """Extract page texts of known companies; append to ``out_path``.
    Returns the A03 statistics (per code, totals) over the written rows."""
    comp = spark.read.parquet(companies_path)
    x = D.extraction_job(pages, comp, run_ts, extract_meta, extract_body, p_only, seq_col)
    x.write.mode("append").parquet(out_path)
    written = spark.read.parquet(out_path).filter(F.col("run_ts") == F.lit(run_ts).cast("timestamp"))
    return D.extraction_stats(written)


def divide_job(spark: SparkSession, companies_path: str, extracted_path: str, dataset_path: str,
               pct=K.SPLIT_PCT, mode: str = "reference") -> None:
    """Exact stratified split of the latest extracted pages (S06 table)."""
    ds = D.build_dataset(spark.read.parquet(companies_path), spark.read.parquet(extracted_path), pct, mode)
    ds.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy("split").parquet(dataset_path)


def corpus_job(spark: SparkSession, dataset_path: str, corpus_path: str,
               min_chars: int = K.MIN_TEXT_CHARS) -> DataFrame:
    """Labelled corpora per split (S07); returns the A04 statistics."""
    ds = spark.read.parquet(dataset_path)
    corpus = D.build_corpus(ds, min_chars, bounds_from=ds.select("seq"))
    T.write_corpora(corpus, corpus_path)
    return D.corpus_stats(spark.read.parquet(corpus_path))


def train_job(spark: SparkSession, corpus_path: str, model_path: str,
              grid: list[dict] | None = None) -> DataFrame:
    """Fit on the train corpus, select on dev, save the best model."""
    c = spark.read.parquet(corpus_path).select("company_id", "split", F.col("sni_code").alias("true_label"),
                                               "text").withColumnRenamed("company_id", "doc_id")
    model, table = L.select_model(c.filter("split = 'train'"), c.filter("split = 'dev'"),
                                  grid or [{"reg": 0.0}, {"reg": 0.01}])
    model.write().overwrite().save(model_path)
    return table


def evaluate_job(spark: SparkSession, dataset_path: str, model_path: str, top_n: int = K.TOP_N,
                 min_chars: int = K.MIN_TEXT_CHARS, mode: str = "reference"):
    """Evaluate on the test split: per-label report, totals, multilabel
    scores and AUC."""
    model = PipelineModel.load(model_path)
    test = spark.read.parquet(dataset_path).filter("split = 'test'")
    test = test.withColumn("true_label", D.primary_code())
    docs = D.assemble_documents(test, ["company_id"], bounds_from=test.select("seq"), carry=("true_label",))
    docs = docs.withColumnRenamed("company_id", "doc_id")
    flags = V.skip_flags(docs, "text", min_chars)
    live = flags.filter("skipped = 0")
    # the predictions are written once; every report reads them
    rows = staged(L.scored_rows(L.score(model, live, ["doc_id", "true_label"]), model), "predictions")
    pred = rows.select("doc_id", "true_label", F.inline("scored"))
    docs = staged(docs.select("doc_id", "true_label", F.substring("text", 1, min_chars).alias("text")), "test_documents")
    per, tot = V.evaluate(docs, rows, top_n, min_chars, mode)
    prf, prf_tot = V.multilabel_scores(pred)
    auc, macro = V.label_auc(pred)
    return V.label_report(per, mode), V.total_report(tot, mode), prf_tot, macro


def predict_job(spark: SparkSession, pages: DataFrame, model_path: str, codes: DataFrame,
                n: int = 10) -> DataFrame:
    """Top-``n`` codes with descriptions for each page (body + meta text)."""
    model = PipelineModel.load(model_path)
    texts = D.extract_pages(pages, filter_=True, keep=["page_id"]).withColumnRenamed("data", "text")
    sc = L.score(model, texts.withColumn("true_label", F.lit(None).cast("string")), ["page_id"])
    rows = L.scored_rows(sc.withColumnRenamed("page_id", "doc_id"), model)
    return V.top_labels(rows, codes, n)
