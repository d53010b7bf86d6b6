"""Property test: the character filters and the year test (Java regex with
(?U)) agree with the same rules run by Python's ``regex`` module on random
Unicode text."""

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from sectorlens.functions import text as T

ALPHABET = list("ab #|\n\t\r09_") + ["é", "́", "²", "Ⅰ", "‍", "‌", "\xa0", " ",
                                      "\x1c", "\x0b", "😀", "漢", "☃", "⏏", "⌚", "Ⓜ",
                                      "♀", "　", "٣", "\U00010348"]

RULES = [r"\s{2,}", r"\|+", r"\n+", r"\t+", r"\r+", r"#\w+",
         "[Ⓜ-\U0010ffff‍⏏⏩⌚]+"]


def py_clean(s: str) -> str:
    for r in RULES:
        s = regex.sub(r, "", s)
    return s


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=50, max_size=80))
def test_clean_chars_matches_python_regex(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r["i"]: (r["c"], r["y"]) for r in
           df.select("i", T.clean_chars("s").alias("c"), T.starts_with_year("s").alias("y")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (py_clean(t), bool(regex.match(r"\d\d\d\d", t))), repr(t)
