"""Scalar text functions as Column expressions.

All are JVM-side expressions (codegen), so a chain of them fuses into one
projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def delete(col, pattern: str) -> Column:
    return F.regexp_replace(_c(col), pattern, "")


def delete_multi_space(col) -> Column:          # E01
    return delete(col, K.CHAR_FILTERS[0])


def delete_pipes(col) -> Column:                # E02
    return delete(col, K.CHAR_FILTERS[1])


def delete_newlines(col) -> Column:             # E03
    return delete(col, K.CHAR_FILTERS[2])


def delete_tabs(col) -> Column:                 # E04
    return delete(col, K.CHAR_FILTERS[3])


def delete_carriage_returns(col) -> Column:     # E05
    return delete(col, K.CHAR_FILTERS[4])


def delete_hashtags(col) -> Column:             # E06
    return delete(col, K.CHAR_FILTERS[5])


def delete_symbols(col) -> Column:              # E07
    return delete(col, K.CHAR_FILTERS[6])


def emoji_class() -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" if a != b else f"\\x{{{a:X}}}"
                         for a, b in K.EMOJI_BLOCKS) + "]+"


def clean_chars(col, mode: str = "reference") -> Column:
    """The character filters, in order, as one fused expression.

    ``reference``: every match is deleted, so words around a deleted run
    fuse, and the symbol class also deletes all CJK and supplementary
    characters. ``clean``: white-space runs, pipes, newlines, tabs and
    carriage returns become one space, hashtags are deleted, only the emoji
    and symbol blocks are deleted, and the result is trimmed.
    """
    if mode == "reference":
        return reduce(lambda acc, p: F.regexp_replace(acc, p, ""), K.CHAR_FILTERS, _c(col))
    x = F.regexp_replace(_c(col), K.CHAR_FILTERS[5], "")                  # hashtags
    x = F.regexp_replace(x, emoji_class(), "")
    x = F.regexp_replace(x, r"(?U)[\s|]+", " ")                          # separators -> one space
    return F.trim(x)


def truncate(col, n: int = K.MAX_TEXT_CHARS) -> Column:
    """First ``n`` code points."""
    return F.substring(_c(col), 1, n)


def join_page_texts(data_col="data") -> Column:
    """Each page text preceded by one space, concatenated in order."""
    return F.coalesce(
        F.array_join(F.transform(_c(data_col), lambda d: F.concat(F.lit(" "), d["data"])), ""),
        F.lit(""))


def starts_with_year(col) -> Column:            # E10
    return _c(col).rlike(K.YEAR_PREFIX)


def category(code) -> Column:                   # E11
    return F.substring(_c(code), 1, 2)


def reciprocal_rank(rank) -> Column:            # E13
    return F.lit(1.0) / _c(rank)


def percentage(correct, total) -> Column:
    """round(correct/total*100, 3); a zero total counts as one."""
    t = _c(total)
    return F.round(_c(correct) / F.when(t > 0, t).otherwise(F.lit(1)) * 100, 3)


def one_hot_labels(codes, y) -> Column:
    """{code: 0} over all known codes with the true code set to 1."""
    allc = F.array_union(_c(codes), F.array(_c(y)))
    return F.map_from_entries(F.transform(allc, lambda c: F.struct(c, (c == _c(y)).cast("int"))))


def normalise_name(col, stop_words=K.NAME_STOP_WORDS) -> Column:
    """Lower-case, delete stop words (spaces are left as they are)."""
    return reduce(lambda acc, w: F.replace(acc, F.lit(w), F.lit("")), stop_words, F.lower(_c(col)))


def contains_any(col, needles: list[str]) -> Column:
    """True when any literal is a substring of ``col``."""
    return F.exists(F.array(*[F.lit(n) for n in needles]), lambda n: F.contains(_c(col), n))


def run_ts_string(ts) -> Column:                # E20
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def strip_dash_space(col) -> Column:            # E21
    return F.translate(_c(col), "- ", "")
