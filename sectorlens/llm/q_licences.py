"""op2: licence scans."""

from __future__ import annotations

from .licences import scan_licences
from .registry import query, table


@query("op2_licences")
def op2_licences(spark, sf_dir):
    return scan_licences(table(spark, sf_dir, "documents")).drop("spans")
