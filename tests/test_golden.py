"""Golden literals (hand-derived expectations) for text, HTML and order rules."""

import pyarrow as pa
from pyspark.sql import functions as F

from sectorlens.functions import text as T
from sectorlens.functions.urls import url_path, with_registered_domain
from sectorlens.operators import html as H
from sectorlens.operators.enrich import has_url_filter


def _one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("x")).first()["x"]


def test_char_filters_in_order(spark):
    s = "a  b|c\nd  e #tåg 😀 漢字 é ☃"
    assert _one(spark, T.clean_chars("s"), s) == "abcde    é "


def test_char_filters_clean_mode(spark):
    s = "a  b|c\nd  e #tåg 😀 漢字 é ☃"
    assert _one(spark, T.clean_chars("s", mode="clean"), s) == "a b c d e 漢字 é"


def _parse(spark, html, url=None):
    df = spark.createDataFrame([(1, html, url)], "id int, html string, url string")
    return H.parse_pages(df, keep=["id"], parts=H.ALL_PARTS)


def test_links_and_scripts_dropped(spark):
    p = _parse(spark, '<body><a href="/x">link</a><p>text</p><script>s</script></body>')
    r = p.select(H.body_strings("nodes", drop_links=True, drop_scripts=True).alias("b")).first()
    assert r["b"] == ["text"]


def test_cookie_div_only(spark):
    p = _parse(spark, '<div class="cookie-bar">c</div><span class="cookie">k</span>')
    assert p.select(H.body_strings("nodes", drop_cookies=True).alias("b")).first()["b"] == ["k"]


def test_nested_paragraphs(spark):
    p = _parse(spark, "<p>a<p>b")
    assert p.select(H.paragraph_strings("paras").alias("b")).first()["b"] == ["ab", "b"]


def test_meta_strings(spark):
    p = _parse(spark, '<meta property="og:title" content="T"><meta name="keywords" content="K">'
                      '<meta name="description">')
    r = p.select(H.meta_strings("metas", True).alias("f"), H.meta_strings("metas", False).alias("u")).first()
    assert r["f"] == ["T", ""]
    assert r["u"] == ["T", "K", ""]


def test_year_filter_modes(spark):
    lst = ["2010 a", "2011 b", "2012 c", "x", "2013", "y", "1999 z", "2000 q"]
    df = spark.createDataFrame([(lst,)], "l array<string>")
    r = df.select(H.drop_year_strings(F.col("l"), "reference").alias("r"),
                  H.drop_year_strings(F.col("l"), "clean").alias("c")).first()
    assert r["r"] == ["2011 b", "x", "y", "2000 q"]
    assert r["c"] == ["x", "y"]


def test_phone_dedup_before_normalising(spark):
    p = _parse(spark, '<a href="tel:08-12 34">a</a><a href="tel:08-1234">b</a>')
    assert p.select(H.phone_numbers("anchors").alias("t")).first()["t"] == ["081234", "081234"]


def test_has_url_modes(spark):
    df = spark.createDataFrame([("a",), ("a b",), ("",), (" ",), (None,)], "url string")
    assert df.filter(has_url_filter("ONLY")).count() == 1
    assert df.filter(has_url_filter("NO")).count() == 3
    assert df.filter(has_url_filter("both")).count() == 5


def test_url_path(spark):
    assert _one(spark, url_path("s"), "http://a.se/om;x=1?q=/en/") == "/om"


def test_registered_domain(spark):
    df = spark.createDataFrame([("https://shop.Example.co.uk/x",), ("http://a.se",), ("nohost",), ("www.foo.se/om",), ("http://10.0.0.1/x",), ("http://beta.mx",)],
                               "url string")
    rows = with_registered_domain(df, "url").select("host", "domain", "suffix").collect()
    assert [tuple(r) for r in rows] == [("shop.example.co.uk", "example", "co.uk"), ("a.se", "a", "se"),
                                        ("nohost", "nohost", ""), ("www.foo.se", "foo", "se"), ("10.0.0.1", "10.0.0.1", ""),
                                        ("beta.mx", "beta", "mx")]


def test_page_text_composition(spark):
    html = ("<html><head><title>T</title><meta name='description' content='D'></head><body>"
            "<p>2019 old</p><p>kept after year</p><p>x</p><p>x</p><a href='/l'>L</a></body></html>")
    p = _parse(spark, html)
    t = p.select(H.page_text(filter_=True).alias("t")).first()["t"]
    # strings: T, 2019 old (dropped), kept after year (skipped test), x, x (dedup) ; meta D
    assert t == "T kept after year x D "


def test_unclosed_paragraphs_parse_in_linear_time():
    import time
    from sectorlens.operators.htmlparse import parse_html
    html = "<b>" + "<p>some words of text" * 20_000 + "</i>" * 20_000
    began = time.time()
    r = parse_html(html)
    assert time.time() - began < 3 and len(r["nodes"]) == 20_000 and r["paras"] is None
    small = parse_html("<p>a<p>b<a>c</a></p>d", with_paras=True)["paras"]
    assert [(q["text_all"], q["text_kept"]) for q in small] == [("abcd", "abd"), ("bc", "b")]


def test_pages_are_parsed_in_bounded_pieces(spark):
    sizes = [0, 3, H.PIECE_BYTES - 4, 1, 5, H.PIECE_BYTES + 9, 2, None]
    batch = pa.RecordBatch.from_arrays([pa.array([None if n is None else "x" * n for n in sizes])], names=["html"])
    found = [[len(x or "") for x in p.column(0).to_pylist()] for p in H.pieces(batch, "html")]
    assert found == [[0, 3, H.PIECE_BYTES - 4, 1], [5], [H.PIECE_BYTES + 9], [2, 0]]


def test_parse_keeps_rows_beside_long_and_missing_pages(spark):
    pages = [(i, f"<p>p{i}</p>" + "<b>x</b>" * (140_000 if i % 4 == 0 else 1) if i % 3 else None) for i in range(1, 13)]
    df = spark.createDataFrame(pages, "id int, html string").coalesce(1).withColumn("at", F.timestamp_seconds("id"))
    rows = H.parse_pages(df, url_col=None, keep=["at", "id"], parts=("nodes",)).collect()
    assert [(r["id"], r["at"].timestamp(), r["ok"], len(r["nodes"] or []), r["metas"], r["links"]) for r in sorted(rows, key=lambda r: r["id"])] == [
        (i, i, i % 3 > 0, (140_001 if i % 4 == 0 else 2) if i % 3 else 0, None, None) for i, _ in pages]
