"""HTML text extraction.

``parse_pages`` is the only Python step (``mapInArrow``, a bounded piece of HTML at a time);
every extraction option is a higher-order-function expression over the
arrays it emits, so a single parse serves all flag combinations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pyspark import cloudpickle

from .. import constants as K
from ..functions.text import clean_chars
from . import htmlparse
from .htmlparse import parse_html
from .ordered import spread_small

# The parse runs in Python workers, which may not have this package on their
# path: ship the parser module by value inside the task closure.
cloudpickle.register_pickle_by_value(htmlparse)

NODE = T.StructType([
    T.StructField("seq", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("in_a", T.BooleanType()),
    T.StructField("in_script", T.BooleanType()),
    T.StructField("in_cookie", T.BooleanType()),
])
META = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("property", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("in_a", T.BooleanType()),
    T.StructField("in_cookie", T.BooleanType()),
])
PARA = T.StructType([
    T.StructField("p_id", T.IntegerType()),
    T.StructField("removed", T.BooleanType()),
    T.StructField("text_all", T.StringType()),
    T.StructField("text_kept", T.StringType()),
])
PARSED = [
    T.StructField("nodes", T.ArrayType(NODE)),
    T.StructField("anchors", T.ArrayType(T.StringType())),
    T.StructField("metas", T.ArrayType(META)),
    T.StructField("paras", T.ArrayType(PARA)),
    T.StructField("links", T.ArrayType(T.StringType())),
    T.StructField("ok", T.BooleanType()),
]


ALL_PARTS = ("nodes", "anchors", "metas", "paras")
#: paragraphs repeat nested text, so they are made only where asked for
DEFAULT_PARTS = ("nodes", "anchors", "metas")
#: HTML whose nodes a worker holds as Python objects at a time; a longer page is parsed alone
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, html_col: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``most`` bytes of HTML, a row at least."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(html_col)), 0), dtype=np.int64))
    first = 0
    while first < batch.num_rows:
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def parse_pages(df: DataFrame, html_col: str = "html", url_col: str | None = "url",
                keep: list[str] | None = None, with_links: bool = False,
                parts: tuple[str, ...] = DEFAULT_PARTS) -> DataFrame:
    """Parse raw HTML into node arrays; the HTML column is dropped.

    ``keep`` lists the columns carried through (default: all but the HTML).
    ``links`` (H13, absolute links resolved against ``url_col``) is only
    filled when ``with_links``; of the other arrays only ``parts`` are
    filled (the rest are NULL), so unused arrays never cross the Arrow
    boundary. A worker parses ``PIECE_BYTES`` of HTML at a time, however many
    rows its Arrow batches have.
    Rows whose HTML cannot be parsed get ``ok = false``; filter them with
    ``.filter("ok")`` (the reference skips such pages).
    """
    keep = keep if keep is not None else [c for c in df.columns if c != html_col]
    cols = list(dict.fromkeys(keep + [html_col] + ([url_col] if url_col and url_col not in keep else [])))
    src = df.select(*cols)
    src = spread_small(src)
    out_schema = T.StructType([src.schema[c] for c in keep] + PARSED)

    types = {f.name: to_arrow_type(f.dataType) for f in PARSED}
    filled = (*parts, "ok", *(("links",) if with_links else ()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for b in pieces(batch, html_col):
                urls = b.column(url_col).to_pylist() if url_col else [None] * b.num_rows
                parsed = [parse_html(h, u, with_links, "paras" in parts) for h, u in zip(b.column(html_col).to_pylist(), urls)]
                made = [pa.array([p[f] for p in parsed], t) if f in filled else pa.nulls(b.num_rows, t) for f, t in types.items()]
                yield pa.RecordBatch.from_arrays([*[b.column(names.index(c)) for c in keep], *made], names=[*keep, *types])

    return src.mapInArrow(run, out_schema)


# -- H02-H06: body strings ------------------------------------------------------

def body_strings(nodes: Column | str = "nodes", drop_links: bool = False,
                 drop_cookies: bool = False, drop_scripts: bool = False) -> Column:
    """H02 (+ H03, H04, H05): stripped, non-empty text strings in document
    order. Comments, doctype and style/script/template strings are not text.
    (The parser already strips with Python's rules and drops empty strings.)
    """
    n = F.col(nodes) if isinstance(nodes, str) else nodes

    def keep(x):
        cond = x["kind"] == "text"
        if drop_links:
            cond = cond & ~x["in_a"]
        if drop_cookies:
            cond = cond & ~x["in_cookie"]
        if drop_scripts:
            cond = cond & ~x["in_script"]
        return cond

    return F.transform(F.filter(n, keep), lambda x: x["text"])


def paragraph_strings(paras: Column | str = "paras", filtered: bool = False) -> Column:
    """One unstripped string per ``<p>`` (all descendant strings, nested
    paragraphs included in their parents)."""
    p = F.col(paras) if isinstance(paras, str) else paras
    if filtered:
        return F.transform(F.filter(p, lambda q: ~q["removed"]), lambda q: q["text_kept"])
    return F.transform(p, lambda q: q["text_all"])


def meta_strings(metas: Column | str = "metas", filtered: bool = True, subtrees_removed: bool = True) -> Column:
    """Meta contents keyed by ``name`` (else ``property``); filtered mode
    keeps keys containing ``title`` or ``description``; missing content is ''.
    Metas below links and cookie divs go only if these subtrees were removed
    (``subtrees_removed``), which happens when the body is extracted."""
    m = F.col(metas) if isinstance(metas, str) else metas
    key = lambda x: F.coalesce(x["name"], x["property"])
    if filtered:
        def wanted(x):
            named = key(x).contains("title") | key(x).contains("description")
            return named & ~x["in_a"] & ~x["in_cookie"] if subtrees_removed else named
        sel = F.filter(m, wanted)
    else:
        sel = F.filter(m, lambda x: key(x).isNotNull())
    return F.transform(sel, lambda x: F.coalesce(x["content"], F.lit("")))


def drop_year_strings(arr: Column, mode: str = "reference") -> Column:
    """Drop strings that start with four digits.

    ``reference``: the element right after each dropped one is kept without
    being tested (the list is edited while it is walked).
    ``clean``: every such string is dropped.
    """
    if mode == "clean":
        return F.filter(arr, lambda s: ~s.rlike(K.YEAR_PREFIX))
    # One character per string: 1 = starts with a year. Inside every run of
    # 1s the 1st, 3rd, 5th... string is dropped (D) and the one after each
    # dropped string is kept untested (K): rewrite "11" -> "DK", then "1" -> "D".
    bits = F.array_join(F.transform(arr, lambda s: F.when(s.rlike(K.YEAR_PREFIX), "1").otherwise("0")), "")
    marks = F.split(F.regexp_replace(F.regexp_replace(bits, "11", "DK"), "1", "D"), "")
    # zip once (a lambda that referred to ``marks`` would re-evaluate it per element)
    zipped = F.arrays_zip(arr.alias("s"), marks.alias("m"))
    return F.transform(F.filter(zipped, lambda z: z["m"] != "D"), lambda z: z["s"])


def _spaced(arr: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(arr, lambda s: F.concat(s, F.lit(" "))), ""), F.lit(""))


def page_text(filter_: bool = True, p_only: bool = False, extract_meta: bool = True,
              extract_body: bool = True, year_mode: str = "reference",
              chars_mode: str = "reference") -> Column:
    """Compose the page text over a parsed page.

    Body strings then meta strings, each followed by one space; with
    ``filter_``: links, cookie divs and scripts are dropped, the year filter
    and first-occurrence de-duplication are applied, and the character
    filters clean the result.
    """
    parts = []
    if extract_body or p_only:
        if p_only:
            body = paragraph_strings("paras", filtered=filter_)
        else:
            body = body_strings("nodes", drop_links=filter_, drop_cookies=filter_,
                                drop_scripts=filter_)
        if filter_:
            body = F.array_distinct(drop_year_strings(body, year_mode))
        parts.append(_spaced(body))
    if extract_meta:
        meta = meta_strings("metas", filtered=filter_, subtrees_removed=extract_body or p_only)
        if filter_:
            meta = F.array_distinct(meta)
        parts.append(_spaced(meta))
    text = F.concat(*parts) if parts else F.lit("")
    return clean_chars(text, chars_mode) if filter_ else text


# -- H11, H12: contact links -----------------------------------------------------

def href_values(anchors: Column | str, keyword: str) -> Column:
    """Values after ``keyword:`` of hrefs that contain the keyword, de-duplicated."""
    a = F.col(anchors) if isinstance(anchors, str) else anchors
    hits = F.filter(a, lambda h: h.contains(keyword) & h.rlike(f"^{keyword}:"))
    return F.array_distinct(F.transform(hits, lambda h: F.regexp_extract(h, f"^{keyword}:(.*)", 1)))


def phone_numbers(anchors: Column | str = "anchors") -> Column:
    """``tel:`` values, de-duplicated first, then '-' and ' ' removed."""
    return F.transform(href_values(anchors, "tel"), lambda s: F.translate(s, "- ", ""))


def email_addresses(anchors: Column | str = "anchors") -> Column:
    """``mailto:`` values, de-duplicated (query suffix kept)."""
    return href_values(anchors, "mailto")


def hrefs_by_regex(html: Column | str) -> Column:
    """Regex-only fast path for double-quoted ``href`` values (no parse)."""
    h = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract_all(h, F.lit(r'<a\s[^>]*href="([^"]*)"'), 1)
