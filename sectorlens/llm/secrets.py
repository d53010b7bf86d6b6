"""Operator 4: secret scans by patterns and sliding-window entropy (DataFrame functions only).

Three base patterns give spans of their own. Besides, strings made of one
character class (hexadecimal, base64) are candidates: a window slides over
each, its character counts are kept incrementally (one character in, one
out), and with them the sum of c * log2(c), which fixes the window's Shannon
entropy. The hull of the windows at or above the class's threshold is a
span, unless an allow-list entry covers the candidate or a base span meets
it. ``by_piece`` (redaction) skips no whole candidate: base spans are cut out
of it, and of what remains the runs of letters and digits that an allow-list
entry meets; the window slides over every piece left, unless an entry meets
the whole piece. Entropy sums are held in integer billionths, so they never drift.

Defined cases: a null text counts as empty; every row gives one row, repeated
rows alike; positions are code points, ends exclusive; an empty table gives
no rows; input columns named like an output column are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
#: kind, candidate strings, window, bits a character at least, characters that a window must hold one of
CLASSES = (
    ("entropy_hex", r"[0-9A-Fa-f]{16,}", 16, 2.9, "0123456789"),
    ("entropy_base64", r"[A-Za-z0-9+/_-]{20,}", 20, 3.85, "0123456789"),
)
ALLOW = (
    r"(?i)example|sample|placeholder|dummy",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)0123456789|abcdefghij",
)
RUN = r"[A-Za-z0-9]+"
MASK = "[REDACTED]"
UNIT = 10 ** 9
_BLOCK = 64
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _upto(n: Column) -> Column:
    """[0, 1, ..., n - 1]."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def running_totals(numbers: Column) -> Column:
    """Running sums of an int array, by blocks: work stays near linear in its length."""
    def of_blocks(a):
        blocks = F.transform(_upto(F.ceil(F.size(a) / _BLOCK).cast("int")),
                             lambda b: F.slice(a, b * _BLOCK + 1, _BLOCK))
        return _let(blocks, lambda bs: _let(F.transform(bs, _total), lambda sums: F.flatten(F.transform(
            bs, lambda part, b: _let(_total(F.slice(sums, 1, b)), lambda base: F.transform(
                part, lambda _, k: base + _total(F.slice(part, 1, k + 1))))))))
    return _let(numbers, of_blocks)


def matches(text: Column, pattern: str) -> Column:
    """(start, end, word) of every leftmost non-overlapping match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    ends = running_totals(F.zip_with(found, F.slice(gaps, 1, F.size(gaps) - 1),
                                     lambda w, gap: F.length(w) + F.length(gap)))
    return F.zip_with(found, ends, lambda w, end: F.struct(
        (end - F.length(w)).alias("start"), end.alias("end"), w.alias("word")))


def _none() -> Column:
    return F.array().cast(_SPAN)


def _spans(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def _assigned(text: Column) -> Column:
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    pairs = F.arrays_zip(matches(text, ASSIGN).alias("m"), value.alias("v"))
    return F.transform(F.filter(pairs, lambda p: F.length(p["v"]) >= 6), lambda p: p["m"])


def base_spans(text: Column) -> Column:
    """Spans of the three base patterns by start, then kind as listed."""
    each = [_spans(f, k, i) for i, (k, f) in enumerate(zip(
        BASE_KINDS, (_assigned(text), matches(text, ACCESS), matches(text, HEX))))]
    gated = [F.when(text.rlike(p), s).otherwise(_none()) for p, s in zip((ASSIGN, ACCESS, HEX), each)]
    return F.array_sort(F.concat(*gated))


def _nlogn(c: Column, window: int) -> Column:
    """c * log2(c) in billionths from a table of the window's possible counts."""
    table = F.array(*[F.lit(round(n * math.log2(n) * UNIT) if n else 0).cast("long") for n in range(window + 1)])
    return F.element_at(table, c + 1)


def high_entropy(word: Column, window: int, bits: float, need: str) -> Column:
    """(first, last): ends of the first and last window of ``word`` at the threshold, 0 if there is none."""
    most = math.floor(window * (math.log2(window) - bits) * UNIT)
    codes = F.transform(F.split(word, ""), lambda c: F.ascii(c))

    def slide(codes: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("long").alias("sum"),
            F.lit(0).alias("at"), F.lit(0).alias("first"), F.lit(0).alias("last"))

        def step(s: Column, code: Column) -> Column:
            gone = F.when(s["at"] >= window, F.get(codes, s["at"] - window)).otherwise(-1)
            return _let(gone, lambda out: _let(F.transform(
                s["counts"], lambda n, k: n + F.when(k == code, 1).otherwise(0) - F.when(k == out, 1).otherwise(0)),
                lambda counts: _let(s["sum"] + F.when(code == out, 0).otherwise(
                    _nlogn(F.get(counts, code), window) - _nlogn(F.get(s["counts"], code), window)
                    + F.when(out >= 0, _nlogn(F.get(counts, out), window) - _nlogn(F.get(s["counts"], out), window))
                    .otherwise(0)),
                    lambda total: _let(
                        (s["at"] + 1 >= window) & (total <= most) & F.exists(
                            F.array(*[F.lit(ord(c)) for c in need]), lambda c: F.get(counts, c) > 0),
                        lambda hit: F.struct(
                            counts.alias("counts"), total.alias("sum"), (s["at"] + 1).alias("at"),
                            F.when((s["first"] == 0) & hit, s["at"] + 1).otherwise(s["first"]).alias("first"),
                            F.when(hit, s["at"] + 1).otherwise(s["last"]).alias("last"))))))
        return F.aggregate(codes, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
    return _let(codes, slide)


def _left(m: Column, places: Column, least: int) -> Column:
    """(start, end, word) of the pieces of ``m``, ``least`` long or more, that no place (sorted by start) touches."""
    def gap(to: Column, end: Column, out: Column) -> Column:
        return F.when(end - to >= least, F.concat(out, F.array(F.struct(to.alias("start"), end.alias("end"))))).otherwise(out)
    none = F.array().cast("array<struct<start:int,end:int>>")
    gaps = F.aggregate(
        places, F.struct(m["start"].alias("to"), none.alias("out")),
        lambda s, p: F.struct(F.greatest(s["to"], p["end"]).alias("to"), gap(s["to"], p["start"], s["out"]).alias("out")),
        lambda s: gap(s["to"], m["end"], s["out"]))
    return F.when(F.size(places) == 0, F.array(m)).otherwise(F.transform(gaps, lambda g: F.struct(
        g["start"].alias("start"), g["end"].alias("end"),
        F.substring(m["word"], g["start"] - m["start"] + 1, g["end"] - g["start"]).alias("word"))))


def entropy_spans(text: Column, base: Column, allow: tuple[str, ...] = ALLOW, by_piece: bool = False) -> Column:
    """Spans of high entropy in candidates that neither an allow-list entry nor a base span meets.

    ``by_piece``: in what base spans and allow-listed runs leave of the candidates.
    """
    def allowed(word: Column) -> Column:
        met = F.lit(False)
        for entry in allow:
            met = met | word.rlike(entry)
        return met
    parts = []
    for rank, (kind, pattern, window, bits, need) in enumerate(CLASSES, len(BASE_KINDS)):
        def beside_base(m):
            return _let(F.filter(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])),
                        lambda met: _left(m, met, window))

        def beside_allowed(m):
            runs = F.transform(F.filter(matches(m["word"], RUN), lambda r: allowed(r["word"])), lambda r: F.struct(
                (m["start"] + r["start"]).alias("start"), (m["start"] + r["end"]).alias("end")))
            return F.when(allowed(m["word"]), F.filter(_let(runs, lambda met: _left(m, met, window)),
                                                       lambda x: ~allowed(x["word"]))).otherwise(F.array(m))
        open_ = F.filter(matches(text, pattern), lambda m: m["word"].rlike(f"[{need}]"))
        if by_piece:
            pieces = F.flatten(F.transform(F.flatten(F.transform(open_, beside_base)), beside_allowed))
        else:
            pieces = F.filter(open_, lambda m: ~allowed(m["word"]) & ~F.exists(
                base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
        rated = F.transform(pieces, lambda m: F.struct(
            m["start"].alias("start"), high_entropy(m["word"], window, bits, need).alias("at")))
        spans = F.transform(F.filter(rated, lambda r: r["at"]["last"] > 0), lambda r: F.struct(
            (r["start"] + r["at"]["first"] - window).alias("start"), F.lit(rank).alias("rank"),
            (r["start"] + r["at"]["last"]).alias("end"), F.lit(kind).alias("kind")))
        parts.append(F.when(text.rlike(pattern), spans).otherwise(_none()))
    return F.concat(*parts)


def scan_secrets(docs: DataFrame, by_piece: bool = False) -> DataFrame:
    """All columns of ``docs`` plus ``base_spans`` and ``spans`` (base and entropy), sorted by start and kind."""
    made = ("base_spans", "spans")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select(*kept, base_spans(text).alias("base_spans"))
            .select("*", _let(F.col("base_spans"), lambda base: F.array_sort(
                F.concat(base, entropy_spans(text, base, by_piece=by_piece)))).alias("spans")))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with each stretch of overlapping spans replaced by ``mask``."""
    def reached(s):
        return F.transform(s, lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.aggregate(
            F.slice(s, 1, i), F.lit(0), lambda m, y: F.greatest(m, y["end"])).alias("to")))
    pieces = F.transform(reached(spans), lambda x: F.when((x["start"] < x["to"]) & (x["to"] > 0), "").otherwise(
        F.concat(F.substring(text, x["to"] + 1, x["start"] - x["to"]), F.lit(mask))))
    end = F.aggregate(spans, F.lit(0), lambda m, y: F.greatest(m, y["end"]))
    rest = F.substring(text, end + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), rest))


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret masked in ``text`` and ``n_chars`` (where there is one) following it."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    scanned = scan_secrets(row, by_piece=True)
    clean = scanned.select("row", F.when(F.size("spans") > 0, redact(F.col("text"), F.col("spans"))).alias("clean"))
    made = {"text": F.col("clean"), "n_chars": F.length("clean")}
    return clean.select(*[
        F.coalesce(made[c].cast(kind), F.col("row")[c]).alias(c) if c in made else F.col("row")[c].alias(c)
        for c, kind in docs.dtypes])
