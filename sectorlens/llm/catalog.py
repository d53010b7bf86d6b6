"""Registered queries of the corpus operators, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from . import q_audit, q_embeddings, q_filters, q_fim, q_langid, q_langmodel, q_leaks, q_licences, q_mixing, q_neardup, q_toxicity, q_urls, q_warc  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
