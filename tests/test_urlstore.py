"""The url store: what is read, merging, dying runs; and the ingest on it."""

import os
import random

from pyspark.sql import functions as F

from sectorlens.sources.urlstore import UrlStore
from sectorlens.streaming.ingest import ingest_new_pages


def frame(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def got(df):
    return sorted(r["url"] for r in df.collect())


def test_membership(spark, tmp_path):
    """Against a plain set, over runs and merges; nulls and repeated urls."""
    rng = random.Random(4)
    store, held = UrlStore(spark, str(tmp_path / "s"), buckets=4, most_generations=2), set()
    assert got(store.seen(frame(spark, ["a"]))) == []
    for run in range(5):
        urls = [f"http://h{rng.randrange(80)}.se/{rng.randrange(3)}" for _ in range(40)]
        new = sorted(set(urls) - held)
        assert set(got(store.seen(frame(spark, urls)))) == set(urls) & held
        store.merge()
        store.add(frame(spark, [*new, *new, None]), f"run{run}")
        held |= set(new)
        assert got(store.urls()) == sorted(held)
    assert len(store.generations()) <= 3 and sum(store.generations().values()) == len(held)
    assert got(store.seen(frame(spark, [None, "http://never.se/0"]))) == []


def test_reads_only_buckets_that_can_match(spark, tmp_path):
    store = UrlStore(spark, str(tmp_path / "s"), buckets=32)
    store.add(frame(spark, [f"http://old{i}.se" for i in range(3000)]), "one")
    asked = frame(spark, ["http://old7.se", "http://new1.se", "http://old99.se"])
    files = store.seen(asked).inputFiles()
    opened = {f.split("bucket=")[1].split("/")[0] for f in files if "bucket=" in f}
    could = {str(r["bucket"]) for r in store.candidates(asked).collect()}
    assert opened == could and 1 <= len(opened) <= 3
    assert got(store.seen(asked)) == ["http://old7.se", "http://old99.se"]
    fresh = frame(spark, [f"http://fresh{i}.se" for i in range(2000)])
    assert store.candidates(fresh).count() < 20          # 16 bits a url, 5 hashes: below 0.3 per cent


def test_filter_never_misses(spark, tmp_path):
    store = UrlStore(spark, str(tmp_path / "s"), buckets=8, bits_per_url=2, hashes=3)
    urls = [f"u{i}" for i in range(500)]
    store.add(frame(spark, urls), "g")
    assert store.candidates(frame(spark, urls)).count() == 500


def test_run_that_dies_while_adding(spark, tmp_path):
    """Files of an unlisted generation and an incomplete manifest change nothing; the same name can be added again."""
    store = UrlStore(spark, str(tmp_path / "s"), buckets=4)
    store.add(frame(spark, ["a", "b"]), "one")
    store._write(frame(spark, ["c"]), "two")
    os.makedirs(tmp_path / "s" / "manifest" / "v=9")
    assert got(store.urls()) == ["a", "b"] and not store.has("two")
    store.add(frame(spark, ["d"]), "two")
    assert got(store.urls()) == ["a", "b", "d"]


def pages(spark, folder, urls, label="l"):
    rows = [(label, u, f"<p>{u}</p>") for u in urls]
    spark.createDataFrame(rows, "label string, url string, raw_html string").coalesce(1).write.mode("append").json(folder)


def test_ingest_repeats_a_batch(spark, tmp_path, monkeypatch):
    """A batch that dies after listing its urls is repeated whole; one that wrote everything appends nothing again."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    pages(spark, src, ["a", "b"])
    ingest_new_pages(spark, src, out, ck, run_id=1)
    pages(spark, src, ["b", "c", "d"])

    def dies(df):
        raise RuntimeError("lost")
    try:
        ingest_new_pages(spark, src, out, ck, transform=dies, run_id=2)
    except Exception:  # noqa: BLE001
        pass
    store = UrlStore(spark, f"{out}_urls")
    assert got(store.urls()) == ["a", "b", "c", "d"] and got(spark.read.parquet(out)) == ["a", "b"]
    ingest_new_pages(spark, src, out, ck, run_id=3)
    assert got(spark.read.parquet(out)) == ["a", "b", "c", "d"]
    commits = [f for f in os.listdir(f"{ck}/commits") if not f.startswith(".")]
    last = max(commits, key=int)
    os.remove(f"{ck}/commits/{last}")
    os.remove(f"{ck}/commits/.{last}.crc")
    ingest_new_pages(spark, src, out, ck, run_id=4)
    rows = spark.read.parquet(out)
    assert got(rows) == ["a", "b", "c", "d"] and rows.agg(F.max("run_id")).first()[0] == 3


def test_output_without_store(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    spark.createDataFrame([("l", "a", "x", 0)], "label string, url string, raw_html string, run_id int").write.parquet(out)
    pages(spark, src, ["a", "b"])
    ingest_new_pages(spark, src, out, ck, run_id=1)
    assert got(spark.read.parquet(out)) == ["a", "b"]


def test_repeated_records_are_written_by_several_tasks(spark, tmp_path):
    """x01_repeated_and_null: each of its files holds every record twice, and no one task writes a run's pages."""
    from pathlib import Path

    from sectorlens.plans import q_io
    from sectorlens.session import ensure_checkpoint_dir
    n = 40
    spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.se/"), F.col("id") % 25).alias("url"),
                          F.concat(F.lit("<p>"), F.col("id")).alias("html")).repartition(4).write.parquet(str(tmp_path / "pages.parquet"))
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "sectorlens-io"
    before = set(folder.glob("x01r-in-*"))
    rows = q_io.x01_repeated(spark, str(tmp_path)).collect()
    assert len(rows) == 25 and len({r["url"] for r in rows}) == 25
    assert {r["url"]: r["run_id"] for r in rows}["http://h.se/1"] == 1      # page 26 has this url too
    (made,) = set(folder.glob("x01r-in-*")) - before
    files = [f.read_text().splitlines() for f in made.glob("part-*")]
    assert len(files) > 4 and sum(map(len, files)) == 2 * (n // 2 + n)
    assert all(len(x) == 2 * len(set(x)) for x in files)
