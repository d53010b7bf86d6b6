"""Documents accumulated over batches against one batch, kept files, repeated batches; id blocks against the membership."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sectorlens.operators import accumulate as A

PAGES = "company_id int, run_ts string, seq int, url string, method array<boolean>, data string"


def rows(n=120, seed=2):
    rng = random.Random(seed)
    out = [(rng.randrange(6), f"r{rng.randrange(2)}", i, f"u{i}", [True], "é" * rng.randrange(12)) for i in range(n)]
    out += [(7, "hot", 1000 + i, "u", [False], "x" * 9) for i in range(60)]
    return out + [(8, "r0", 5000, None, None, None), (None, "r0", 5001, "u", [True], "no company"), (8, None, 5002, "u", [True], "no run")]


def documents(spark, path, cut):
    return {(r["company_id"], r["run_ts"]): (r["n_pages"], r["total_chars"], r["text"], [p["url"] for p in r["data"]])
            for r in A.accumulated_documents(spark, path, cut).collect()}


def brute(batches, cut):
    docs = {}
    for batch in batches:
        for r in sorted(batch, key=lambda r: r[2]):
            docs.setdefault(r[:2], []).append(r)
    out = {}
    for key, pages in docs.items():
        text, kept = "", []
        for p in pages:
            if len(text) < cut:
                kept.append(p[3])
            text += " " + (p[5] or "")
        out[key] = (len(pages), len(text), text[:cut], kept)
    return out


def test_batches_equal_one(spark, tmp_path):
    """Three batches, one of them run twice, and the cut inside, at and beyond batch borders."""
    every, cut = rows(), 100
    batches = [every[:70], [r for r in every[70:] if r[2] % 2], [r for r in every[70:] if not r[2] % 2]]
    path = str(tmp_path / "a")
    for i, part in enumerate([*batches[:2], batches[1], batches[2]]):
        name = ["b0", "b1", "b1", "b2"][i]
        A.accumulate_pages(spark.createDataFrame(part, PAGES), path, name, buckets=4, max_chars=cut)
    assert documents(spark, path, cut) == brute(batches, cut)
    one = str(tmp_path / "b")
    A.accumulate_pages(spark.createDataFrame(every, PAGES), one, "all", buckets=4, max_chars=cut)
    assert documents(spark, one, cut) == brute([every], cut)


def test_other_folders_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "a")
    A.accumulate_pages(spark.createDataFrame(rows(), PAGES), path, "1", buckets=16)
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    A.accumulate_pages(spark.createDataFrame([(3, "r0", 9000, "u", [True], "later page")], PAGES), path, "2", buckets=16)
    after = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    assert all(after[f] == t for f, t in before.items())
    new = [str(f) for f in after if f not in before]
    assert len(new) == 2 and all("batch=2" in f for f in new)
    assert documents(spark, path, 10 ** 6)[(3, "r0")][2].endswith("later page")


def test_empty_batch(spark, tmp_path):
    path = str(tmp_path / "a")
    A.accumulate_pages(spark.createDataFrame(rows(), PAGES), path, "1", buckets=2, max_chars=50)
    A.accumulate_pages(spark.createDataFrame([], PAGES), path, "2", buckets=2, max_chars=50)
    assert documents(spark, path, 50) == brute([rows()], 50)


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.integers(-50, 400), st.sampled_from(["a", "b", None]), max_size=60), st.integers(1, 9))
def test_id_blocks(spark, members, block):
    frame = spark.createDataFrame([(i, c, "http://x") for i, c in members.items()] + [(999, "a", " "), (998, "b", None)],
                                  "company_id int, code string, url string")
    blocks = A.company_id_blocks(frame, F.col("code"), block)
    found = blocks.collect()
    assert all(1 <= r["n"] <= block and len(r["deltas"]) == r["n"] - 1 for r in found)
    for code in {"a", "b", None}:
        sizes = [r["n"] for r in sorted((r for r in found if r["code"] == code), key=lambda r: r["block"])]
        assert all(n == block for n in sizes[:-1])
    assert {(r["code"], r["company_id"]) for r in A.decoded_blocks(blocks).collect()} == {(c, i) for i, c in members.items()}
    assert A.decoded_blocks(blocks).count() == len(members)
