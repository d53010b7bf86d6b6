"""WARC archives: round trip, ZIP validity, directories of other writers, and the oracle."""

import io
import zipfile

import pandas as pd
import pytest

from sectorlens.llm import q_warc
from sectorlens.llm import warc as W
from sectorlens.llm.registry import QUERIES
from tests.llm.common import SF, duck, same, spark_rows

PAGES = [(5, "http://a/\r\nx y", "é" * 60), (3, None, "é" * 60), (None, "http://n", "é" * 60), (3, "http://r", "é" * 60), (7, "u", None),
         (8, "u", ""), (1, "s", "short"), (2, "s", "short"), (9, "big", "x" * 300_000), (10, "", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20),
         (None, "u", "n" * 100), (None, "v", "n" * 100)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "mine") for r in rows], "page_id bigint, url string, html string, payload string")


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_round_trip(spark, size):
    archives = W.write_archives(frame(spark, PAGES), size)
    got = W.read_archives(archives, payload=True)
    pages = pd.DataFrame(PAGES, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"})
    same(spark_rows(got.drop("url", "payload")), duck(q_warc.ORACLE, pages=pages))
    for r in got.collect():
        texts = {(h or "").encode() for i, u, h in PAGES if i == r["page_id"]}
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        assert r["payload"] is None or bytes(r["payload"]) in texts
    assert "http://a/%0D%0Ax%20y" in {r["url"] for r in got.collect()}
    for r in archives.collect():
        with zipfile.ZipFile(io.BytesIO(r["archive"])) as z:
            assert z.testzip() is None and z.namelist() == [W.WARC_MEMBER, W.INDEX_MEMBER]


def test_other_writers(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("plain", b"abc" * 10)
        with z.open(zipfile.ZipInfo("wide"), "w", force_zip64=True) as f:
            f.write(b"wide member")
        z.writestr("packed", b"x" * 99, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"a comment"
    read_at = W.file_reader(str(path))
    members = W.zip_members(read_at, path.stat().st_size)
    assert {n: read_at(*m) for n, m in members.items()} == {"plain": b"abc" * 10, "wide": b"wide member"}
    with pytest.raises(ValueError):
        W.zip_members(W.bytes_reader(b"no archive"), 10)


def test_damage_is_noticed():
    record = W.warc_record(1, "u", b"payload", "0" * 64, None)
    with pytest.raises(ValueError):
        W.read_record(record)


def test_empty(spark):
    assert W.read_archives(W.write_archives(frame(spark, PAGES).limit(0))).count() == 0


def test_whole_table(spark):
    same(spark_rows(QUERIES["op3_warc"](spark, SF)), duck(q_warc.ORACLE))
