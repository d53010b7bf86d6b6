"""Decontamination: edge cases against DuckDB, proximity and blocks against brute force."""

import pandas as pd
import pytest

from sectorlens.llm import q_leaks
from sectorlens.llm.decontaminate import find_leaks, remove_leaks
from sectorlens.llm.registry import QUERIES
from sectorlens.llm.words import alnum_words
from tests.llm.common import SF, docs, duck, same, spark_rows

TEN = "one two three four five six seven eight nine ten"
TEXTS = [None, "", "!!! --", TEN.upper() + " x", "a " + TEN + " " + TEN + " eleven", "one two three", "ÀB c é", "àb c é",
         "ten nine eight seven six five four three two one", TEN.replace(" ", "-"), "z " * 900 + TEN,
         "two three four five six seven eight nine ten eleven twelve", "the the the the the the the the the the the"]
ITEMS = [(1, TEN + " eleven twelve"), (2, "Àb, C! é"), (10, TEN), (3, None), (4, "..."), (5, "the " * 10), (None, "three two one"),
         (1, "one two three"), (1, "one two three")]
COLS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_cases(spark, block):
    rows = [*enumerate(TEXTS), (3, TEN), (None, TEN)]
    frame = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    got = find_leaks(docs(spark, rows), bench(spark, ITEMS[:6] + ITEMS[7:]), block_bytes=block).select(*COLS)
    items = pd.DataFrame(ITEMS[:6] + ITEMS[7:], columns=["item_id", "text"]).astype({"item_id": "Int64"})
    same(spark_rows(got), duck(q_leaks.ORACLE, documents=frame, benchmark=items))


def test_null_item_and_empty_tables(spark):
    d = docs(spark, ["x three two one", "clean"]).selectExpr("*", "1 as n_hit", "2 as row")
    got = {r["doc_id"]: r for r in find_leaks(d, bench(spark, ITEMS)).collect()}
    assert got[0]["n_hit"] == 3 and got[0]["n_items"] == 0 and got[0]["contaminated"]
    assert [r["doc_id"] for r in remove_leaks(d, bench(spark, ITEMS)).collect()] == [1]
    assert remove_leaks(d, bench(spark, ITEMS)).columns == d.columns
    assert [r["n_hit"] for r in find_leaks(d, bench(spark, [])).collect()] == [0, 0]
    assert find_leaks(d.limit(0), bench(spark, ITEMS)).count() == 0


def test_proximity(spark):
    texts = [TEN, "ten nine eight seven six five four three two one", "one " + "x " * 50 + TEN[4:], "one two " + "y " * 8 + TEN[8:]]
    d = docs(spark, texts)
    got = [r["n_near"] for r in find_leaks(d, bench(spark, [(1, TEN)])).orderBy("doc_id").collect()]

    def brute(text):
        w = alnum_words(text.encode())
        need = set(TEN.encode().split())
        rare = min(need, key=lambda t: w.count(t))
        return int(any(need <= set(w[max(0, i - 20):i + 21]) for i, t in enumerate(w) if t == rare))
    assert got == [brute(t) for t in texts] == [1, 1, 0, 1]


def test_whole_table(spark):
    same(spark_rows(QUERIES["op6_decontamination"](spark, SF)), duck(q_leaks.ORACLE))


def test_very_long_text(spark):
    got = find_leaks(docs(spark, ["z " * 400000 + TEN + " z" * 100]), bench(spark, [(1, TEN)])).first()
    assert (got["n_words"], got["n_hit"], got["items"]) == (400110, 10, ["1"])


def test_proximity_of_every_window(spark):
    """Any window of an item in reverse order is found nearby, and the item is listed."""
    words = [f"w{i}" for i in range(17)]
    texts = [" ".join(words[i:i + 10][::-1]) for i in range(8)] + [" ".join(words[i:i + 9][::-1]) for i in range(9)]
    got = find_leaks(docs(spark, texts), bench(spark, [(7, " ".join(words)), (8, TEN)])).orderBy("doc_id").collect()
    assert [r["near_items"] for r in got] == [["7"]] * 8 + [[]] * 9
    assert [r["n_near"] for r in got] == [1] * 8 + [0] * 9 and not any(r["contaminated"] for r in got)


def test_proximity_query(spark):
    rows = QUERIES["op6_proximity"](spark, SF).collect()
    exact = {r["doc_id"]: r["n_items"] for r in QUERIES["op6_decontamination"](spark, SF).collect()}
    assert all(r["n_near"] == len(r["near_items"]) >= exact[r["doc_id"]] for r in rows) and len(rows) == len(exact)
