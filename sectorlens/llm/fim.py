"""Operator 13: fill-in-middle transformation, cut by arithmetic on eight bytes at once.

A text is cut into units ``[A-Za-z]+|[^A-Za-z]`` over code points. Its UTF-8
bytes are viewed as 64-bit words: the last byte of each unit is marked by
arithmetic on whole words (a byte ends a unit unless the next byte continues
its code point or both are letters), the marks of a word are counted by
``bitwise_count``, and the k-th unit's end is found by a search in the
running counts and a select inside the word. Two hashes of the document's id
choose the cuts, two more the form.

Defined cases: a null text counts as empty; a null ``doc_id`` hashes as the
empty string; empty texts and texts that hold a sentinel stay plain; repeated
rows are cut alike; malformed bytes are cut by the same byte rule and come
back unchanged; an empty table gives no rows; input columns named like an
output column are replaced by it. A chunk holds 16 MB of text, or one longer
text, and about three times that in marks and counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textmap import map_texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM, SPM_BELOW = 90, 20
OUT = "n long, form string, prefix_chars long, middle_chars long, output string"
_SENTINELS = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]
_CONTINUING = bytes(range(0x80, 0xC0))
_STEP_WORDS = 1 << 16


def _each(byte: int) -> np.uint64:
    """A word whose eight bytes are ``byte``."""
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW7, _ONES, _CASE = _each(0x80), _each(0x7F), _each(1), _each(0x20)
_FROM_A, _PAST_Z = _each(0x80 - ord("a")), _each(0x80 - ord("z") - 1)


def letters(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is an ASCII letter."""
    low = (words & _LOW7) | _CASE
    return (low + _FROM_A) & ~(low + _PAST_Z) & ~words & _HIGH


def continuing(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that continues a code point (binary 10xxxxxx)."""
    return words & ~(words << np.uint64(1)) & _HIGH


def unit_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that ends a unit; ``words`` ends with a word of zeros."""
    marks = np.zeros(len(words), dtype=np.uint64)
    for at in range(0, len(words) - 1, _STEP_WORDS):
        part = words[at:at + _STEP_WORDS + 1]
        letter, more = letters(part), continuing(part)

        def following(bits: np.ndarray) -> np.ndarray:
            return (bits[:-1] >> np.uint64(8)) | (bits[1:] << np.uint64(56))
        marks[at:at + len(part) - 1] = _HIGH & ~following(more) & ~(letter[:-1] & following(letter))
    return marks


class Units:
    """Ends of the units of texts that lie one after the other in ``data`` (the bytes at ``starts`` to ``ends``)."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray):
        words = np.zeros(len(data) // 8 + 2, dtype=np.uint64)
        words.view(np.uint8)[:len(data)] = np.frombuffer(data, dtype=np.uint8)
        self.marks = unit_marks(words)
        last = ends[ends > starts] - 1
        np.bitwise_or.at(self.marks, last >> 3, np.uint64(0x80) << (8 * (last & 7)).astype(np.uint64))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])
        self.starts, self.first = starts, self.rank(starts)
        self.n = self.rank(ends) - self.first

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Units that end before each byte place."""
        word, below = place >> 3, (np.uint64(1) << (8 * (place & 7)).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def after(self, k: np.ndarray) -> np.ndarray:
        """The byte place after the first ``k`` units of each text."""
        nth = np.maximum(self.first + k, 1)
        word = np.searchsorted(self.before, nth, "left") - 1
        upto = (self.marks[word] >> np.uint64(7)) * _ONES
        wanted = (nth - self.before[word]).astype(np.uint64) * _ONES
        reached = ((upto | _HIGH) - wanted) & _HIGH
        return np.where(k > 0, 8 * word + 9 - np.bitwise_count(reached).astype(np.int64), self.starts)


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4]) for i in (0, 4, 8, 12)]


def code_points(part: bytes) -> int:
    return len(part.translate(None, _CONTINUING))


def as_strings(values: Sequence[bytes]) -> pa.Array:
    """A string array of the bytes as they are."""
    held = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(held), held.buffers())


def fill_in_middle(docs: DataFrame, keep: Sequence[str] = ("doc_id",), seed: int = SEED,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``keep`` columns plus n (units), form, prefix_chars, middle_chars and output.

    The third draw leaves a text plain from ``plain_from`` per cent on, the
    fourth makes it suffix-prefix-middle below ``spm_below`` per cent.
    """
    p, s, m = _SENTINELS
    kept = ["doc_id", *[c for c in keep if c != "doc_id"]]

    def make():
        def compute(texts, rows):
            texts = [t or b"" for t in texts]
            drawn = np.array([draws(i, seed) for i in rows.column(0).to_pylist()], dtype=np.int64).reshape(-1, 4)
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            starts = ends - [len(t) for t in texts]
            units = Units(b"".join(texts), starts, ends)
            cuts = np.sort(drawn[:, :2] % (units.n + 1)[:, None], axis=1)
            first = (units.after(cuts[:, 0]) - starts).tolist()
            second = (units.after(cuts[:, 1]) - starts).tolist()
            forms, heads, middles, outputs = [], [], [], []
            for text, a, b, h3, h4 in zip(texts, first, second, drawn[:, 2].tolist(), drawn[:, 3].tolist()):
                plain = not text or h3 % 100 >= plain_from or any(x in text for x in _SENTINELS)
                head, middle, tail = text[:a], text[a:b], text[b:]
                spm = h4 % 100 < spm_below
                forms.append("plain" if plain else "spm" if spm else "psm")
                heads.append(None if plain else code_points(head))
                middles.append(None if plain else code_points(middle))
                outputs.append(text if plain else b"".join((s, tail, p, head, m, middle) if spm else (p, head, s, tail, m, middle)))
            return [units.n, forms, heads, middles, as_strings(outputs)]
        return compute
    done = map_texts(docs, "text", kept, OUT, make)
    return done if "doc_id" in keep else done.drop("doc_id")


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of: no sentinel can arise where a piece meets one, so each stands once."""
    def between(left: str, right: str) -> Column:
        return F.substring_index(F.substring_index(output, right, 1), left, -1)
    middle = F.substring_index(output, MIDDLE, -1)
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(output))
