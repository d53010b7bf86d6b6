"""Operator 11: filter interaction audit by a Gray-code walk over the subsets of filters.

Every document gets a mask of the filters it fails; documents with the same
part, mask and labels fall into one cell (32 masks a part). The walk visits
the 32 subsets of filters in Gray-code order, so each step switches one
filter: the cells whose mask holds it count one active failure more or less,
and a cell whose counter leaves or reaches 0 is taken from or given back to
the running survivors. The survivors of the 32 subsets are stored; what a
filter removes at a step of any order is the difference of two of them.

Equal texts are found by digest. The rows of a digest are summed by part,
mask and labels before its smallest doc_id is looked up, so a text that a
third of all rows share is a few rows by then.

Defined cases: a null text counts as empty (and equals other empty texts); a
null source is the part ``""``; a null ``doc_id`` is smaller than none, has no
smaller one and no labels; rows with the same text and ``doc_id`` do not
remove each other; of several label rows of a document any 1 counts; a part
without failures has rows of zeros; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored
from .textmap import map_texts

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2
PIECE = 1 << 20
COUNTS = ("kept", "good", "toxic")
STATES = "part string, " + ", ".join(f"{c} array<long>" for c in COUNTS)
STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUING = bytes(range(0x80, 0xC0))
_SIGNS = b"#$%&*|"
_SPACE = b" \t\n\x0b\x0c\r"


def pieces(text: bytes, size: int = PIECE):
    """``text`` in pieces of about ``size`` bytes, cut behind a whitespace byte."""
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end - 1] not in _SPACE:
            end += 1
        yield text[at:end]
        at = end


def word_counts(text: bytes) -> tuple[int, int]:
    """(words, distinct words); only the distinct ones are held together."""
    n, seen = 0, set()
    for piece in pieces(text):
        words = piece.split()
        n += len(words)
        seen.update(words)
    return n, len(seen)


def failures(text: bytes) -> int:
    """The mask of filters A to D that the text fails."""
    words, distinct = word_counts(text)
    points = len(text.translate(None, _CONTINUING))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    signs = len(text) - len(text.translate(None, _SIGNS))
    return ((words < MIN_WORDS) | (100 * distinct < MIN_DISTINCT * words) << 1
            | (100 * capitals > MAX_CAPITALS * points) << 2 | (signs > 0) << 3)


def document_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) per document; the mask knows A to D."""
    def make():
        def compute(texts, _):
            texts = [t or b"" for t in texts]
            return [[failures(t) for t in texts], [hashlib.blake2b(t, digest_size=16).digest() for t in texts]]
        return compute
    rows = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("part"), "text")
    return map_texts(rows, "text", ["doc_id", "part"], "mask int, digest binary", make)


def with_labels(masks: DataFrame, labels: DataFrame) -> DataFrame:
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return masks.join(marked, "doc_id", "left").fillna(0, ["good", "toxic"])


def mask_cells(masks: DataFrame) -> DataFrame:
    """(part, mask, kept, good, toxic): documents per part and full mask."""
    alike = ["digest", "part", "mask", "good", "toxic"]
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    groups = stored(masks.groupBy("doc_id", *alike).agg(F.count(F.lit(1)).alias("n"))
                    .groupBy(*alike).agg(F.sum("n").alias("n"), first.alias("first"),
                                         F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id")), "audit-groups")
    least = groups.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    passing = F.col("no_id") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    last = 1 << (len(FILTERS) - 1)
    both = F.array(F.struct(F.col("mask").alias("mask"), passing.alias("kept")),
                   F.struct((F.col("mask") + last).alias("mask"), (F.col("n") - passing).alias("kept")))
    split = groups.join(least, "digest").select("part", "good", "toxic", F.inline(both))
    return split.groupBy("part", "mask").agg(F.sum("kept").alias("kept"), F.sum(F.col("kept") * F.col("good")).alias("good"),
                                             F.sum(F.col("kept") * F.col("toxic")).alias("toxic"))


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters; ``cells`` and the result are (rows, 32, counts)."""
    holds = (np.arange(ALL + 1)[:, None] >> np.arange(len(FILTERS))) & 1 == 1
    states = np.empty_like(cells)
    failing = np.zeros(ALL + 1, dtype=np.int64)
    alive = cells.sum(axis=1)
    subset = 0
    states[:, 0] = alive
    for i in range(1, ALL + 1):
        flip = (i & -i).bit_length() - 1
        subset ^= 1 << flip
        on = subset >> flip & 1
        failing[holds[:, flip]] += 1 if on else -1
        moved = holds[:, flip] & (failing == (1 if on else 0))
        alive = alive + (-1 if on else 1) * cells[:, moved].sum(axis=1)
        states[:, subset] = alive
    return states


def subset_states(cells: DataFrame) -> DataFrame:
    """Per part the 32 states, as one array of 32 per count, indexed by the subset's mask."""
    rows = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))

    def run(batches):
        for batch in batches:
            held = np.zeros((batch.num_rows, ALL + 1, len(COUNTS)), dtype=np.int64)
            for row, found in enumerate(batch.column(1).to_pylist()):
                for cell in found:
                    held[row, cell["mask"]] = [cell[c] for c in COUNTS]
            states = gray_walk(held)
            arrays = [pa.array(list(states[:, :, i]), pa.list_(pa.int64())) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["part", *COUNTS])
    return rows.mapInArrow(run, STATES)


def step_table(n: int = len(FILTERS)) -> list[tuple[str, int, int, int]]:
    """(order, step, subset before, subset after) of every step of every order."""
    out = []
    for order in permutations(range(n)):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[i] for i in order), step, before, before | 1 << f))
            before |= 1 << f
    return out


def _literal(rows: list[tuple[str, int, int, int]]) -> Column:
    text = ",".join(f"named_struct('filter_order','{o}','step',{s},'before',{b},'after',{a})" for o, s, b, a in rows)
    return F.expr(f"array({text})")


def audit_steps(states: DataFrame) -> DataFrame:
    """One row per part, order and step: differences of the stored states."""
    n = len(FILTERS)
    steps = states.select("*", F.inline(_literal(step_table())))

    def at(count: str, subset: Column) -> Column:
        return F.get(F.col(count), subset)

    def lost(count: str) -> Column:
        return at(count, F.col("before")) - at(count, F.col("after"))
    own = F.col("after") - F.col("before")
    failing = at("kept", F.lit(0)) - at("kept", own)
    shapley = F.lit(0).cast("long")
    for subset in range(ALL + 1):
        size = bin(subset).count("1")
        if size < n:
            times = factorial(size) * factorial(n - 1 - size)
            shapley = shapley + F.when(F.lit(subset).bitwiseAND(own) == 0, times * (
                at("kept", F.lit(subset)) - at("kept", F.lit(subset).bitwiseOR(own)))).otherwise(0)
    return steps.select(
        "part", "filter_order", "step", at("kept", F.col("after")).alias("kept"), lost("kept").alias("removed"),
        (failing - lost("kept")).alias("redundant"), (at("kept", F.lit(ALL) - own) - at("kept", F.lit(ALL))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), shapley.alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over ``docs``, part by part."""
    return audit_steps(subset_states(mask_cells(with_labels(document_masks(docs), labels))))
