"""op9: language-model scores."""

from __future__ import annotations

from .langmodel import score_documents
from .registry import query, table


@query("op9_lm_scoring")
def op9_lm_scoring(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
