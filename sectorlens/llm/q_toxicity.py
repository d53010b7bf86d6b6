"""op12: toxicity."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query, table
from .toxicity import fit, held_out, score_toxicity


@query("op12_toxicity")
def op12_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score_toxicity(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
