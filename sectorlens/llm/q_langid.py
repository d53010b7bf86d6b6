"""op8: language ID."""

from __future__ import annotations

from pyspark.sql import functions as F

from .langid import fit, held_out, identify
from .registry import query, table


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
