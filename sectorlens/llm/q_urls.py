"""op7: URL filters."""

from __future__ import annotations

from .registry import query, table
from .urlfilter import judge_urls


@query("op7_url_filters")
def op7_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
