"""Operator 8: language ID with spans of mixed-language text.

Each word gets a score per language, the log probability of its character
trigrams (with word boundaries) hashed to ``BUCKETS`` counts a language. The
word's script narrows the candidates to languages that were seen in it. A
Viterbi pass over a document's words, with a fixed penalty for changing the
language, labels every word; stretches of one label are the spans. A
document's language is the one that labels most letters.

The counts cover all labelled training rows. A model holds BUCKETS numbers a
language, whatever the corpus size; only that is gathered and broadcast.

Defined cases: null texts and texts without a letter give ``und`` with score
0, as does everything if no labelled row exists; words in scripts that no
language was seen in support none (a text of only such words gets the first
language with score and known 0); a null doc_id counts as the empty string in the
fold; ties go to the first language in code-point order; repeated rows are
predicted alike; bytes that are no UTF-8 end a word; input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textmap import chunks, map_texts, numbered, renamed_back

BUCKETS = 1 << 16
SWITCH_PENALTY = 8.0
SCRIPT_SHARE = 0.01
OUTSIDE_SCRIPT = 25.0
LIKELY_MARGIN = 0.5
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
OUT = "lang_pred string, score double, known double, spans array<struct<lang:string,start:int,end:int>>"
LETTERS = re.compile(r"[^\W\d_]+")
# First code points of script ranges; what lies before a range's successor belongs to it.
SCRIPTS = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
           (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
           (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"))
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([s for s, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def words_of(text: bytes | None) -> list[str]:
    """Lower-cased runs of letters; none if the text has no alphabetic character."""
    words = LETTERS.findall(text.decode(errors="replace").lower()) if text else []
    return words if any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w) else []


def features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram buckets of all words, where each word's begin, script of each word)."""
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    ends = points == 3
    inside = ~ends[:-2] & ~ends[1:-1]
    mixed = (points[:-2] * 0x9E3779B1 + points[1:-1] * 0x85EBCA77 + points[2:] * 0xC2B2AE3D) & 0xFFFFFFFF
    buckets = ((mixed ^ (mixed >> 15)) & (BUCKETS - 1))[inside]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    first = np.concatenate([[0], np.cumsum(lengths + 2)])[:-1] + 1
    scripts = _SCRIPT[np.searchsorted(_STARTS, points[first], "right") - 1]
    return buckets, np.concatenate([[0], np.cumsum(lengths)])[:-1], scripts


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray     # BUCKETS x languages, log probabilities
    candidates: np.ndarray  # scripts x languages

    @classmethod
    def of(cls, rows: Sequence[tuple[str, int, int]]) -> "Model":
        """From summed (lang, bucket, n); buckets below 0 count words by script."""
        langs = sorted({r[0] for r in rows})
        counts = np.zeros((BUCKETS, len(langs)))
        scripts = np.zeros((len(SCRIPT_NAMES), len(langs)))
        place = {la: i for i, la in enumerate(langs)}
        for lang, bucket, n in rows:
            (counts if bucket >= 0 else scripts)[bucket if bucket >= 0 else -1 - bucket, place[lang]] = n
        smooth = 0.1
        weights = np.log((counts + smooth) / (counts.sum(0) + smooth * BUCKETS))
        return cls(langs, weights.astype(np.float32), scripts >= np.maximum(SCRIPT_SHARE * scripts.sum(0), 1))

    def scores(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score per word and language, whether any language is a candidate, whether one is likely); words in slices of bounded size.

        A language is likely if the word's mean log probability of a trigram in it beats
        that of evenly spread buckets by ``LIKELY_MARGIN``.
        """
        step = max(1, 400_000 // max(1, len(self.langs)))
        parts, known, likely = [], [], []
        for i in range(0, len(words), step):
            buckets, starts, scripts = features(words[i:i + step])
            score = np.add.reduceat(self.weights[buckets], starts, axis=0)
            allowed = self.candidates[scripts]
            some = allowed.any(1)
            trigrams = np.diff(np.append(starts, len(buckets)))
            best = np.where(allowed, score, -np.inf).max(1, initial=-np.inf)
            likely.append(best / trigrams > LIKELY_MARGIN - np.log(BUCKETS))
            floor = np.where(allowed, score, np.inf).min(1, initial=np.inf, keepdims=True) - OUTSIDE_SCRIPT
            score = np.where(allowed, score, np.minimum(score, floor))
            score[~some] = 0
            parts.append(score)
            known.append(some)
        return np.concatenate(parts), np.concatenate(known), np.concatenate(likely)


def viterbi(scores: np.ndarray, ids: np.ndarray, sizes: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best label of every word of many documents at once (``ids`` are the words' rows in ``scores``).

    Documents advance together, longest first, so that those still running
    are a prefix; a change costs ``penalty`` whatever the two languages.
    """
    order = np.argsort(-sizes, kind="stable")
    offsets = (np.concatenate([[0], np.cumsum(sizes)])[:-1])[order]
    longest = sizes[order]
    running = np.searchsorted(-longest, -np.arange(longest[0] if len(longest) else 0), "left")
    value = np.zeros((len(order), scores.shape[1]))
    stays = np.zeros((len(ids), scores.shape[1]), dtype=bool)
    came = np.zeros(len(ids), dtype=np.int16)
    for t, n in enumerate(running.tolist()):
        at, now = offsets[:n] + t, value[:n]
        best = now.max(1) - penalty
        came[at] = now.argmax(1)
        stay = now >= best[:, None]
        stays[at] = stay
        value[:n] = np.where(stay, now, best[:, None]) + scores[ids[at]]
    state = value.argmax(1)
    labels = np.zeros(len(ids), dtype=np.int16)
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        at = offsets[:n] + t
        labels[at] = state[:n]
        state[:n] = np.where(stays[at, state[:n]], state[:n], came[at])
    return labels


def count_trigrams(labelled: DataFrame) -> DataFrame:
    """Summed (lang, bucket, n) over all rows of (lang, text); each task sends at most BUCKETS rows a language."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for rows, part in chunks(batch, texts):
                seen: dict[str, dict[str, int]] = {}
                for lang, text in zip(rows.column(0).to_pylist(), part.to_pylist()):
                    mine = seen.setdefault(lang, {})
                    for w in words_of(text):
                        mine[w] = mine.get(w, 0) + 1
                for lang, mine in seen.items():
                    if mine:
                        total = counts.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), dtype=np.int64))
                        buckets, starts, scripts = features(list(mine))
                        times = np.fromiter(mine.values(), dtype=np.int64, count=len(mine))
                        lengths = np.diff(np.append(starts, len(buckets)))
                        total[:BUCKETS] += np.bincount(buckets, np.repeat(times, lengths), BUCKETS).astype(np.int64)
                        total[BUCKETS:] += np.bincount(scripts, times, len(SCRIPT_NAMES)).astype(np.int64)
        for lang, total in counts.items():
            at = np.flatnonzero(total)
            bucket = np.where(at < BUCKETS, at, BUCKETS - 1 - at)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(bucket, pa.int32()),
                                              pa.array(total[at], pa.int64())], names=["lang", "bucket", "n"])
    return (labelled.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame) -> Model:
    """A model of the rows with a language that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    return Model.of([tuple(r) for r in count_trigrams(labelled).collect()])


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), penalty: float = SWITCH_PENALTY,
             text: str = "text") -> DataFrame:
    """``keep`` columns plus lang_pred, score, known and spans (word numbers, ends exclusive).

    ``score`` is the share of letters labelled ``lang_pred``, ``known`` that of letters of words likely in any language
    (random letters of a known script are labelled, but not known).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        langs = np.array(model.langs + [UNKNOWN], dtype=object)
        n_langs = len(model.langs)

        def compute(texts, _):
            vocabulary: dict[str, int] = {}
            ids, sizes = [], []
            for text in texts:
                words = words_of(text) if n_langs else []
                ids += [vocabulary.setdefault(w, len(vocabulary)) for w in words]
                sizes.append(len(words))
            if not ids:
                return [[UNKNOWN] * len(sizes), [0.0] * len(sizes), [0.0] * len(sizes), [[] for _ in sizes]]
            ids, sizes = np.array(ids), np.array(sizes)
            words = list(vocabulary)
            scores, known, likely = model.scores(words)
            labels = viterbi(scores, ids, sizes, penalty)
            letters = np.fromiter(map(len, words), dtype=np.int64, count=len(words))[ids]
            doc = np.repeat(np.arange(len(sizes)), sizes)
            won = np.bincount(doc * n_langs + labels, letters * known[ids], len(sizes) * n_langs).reshape(-1, n_langs)
            every = np.bincount(doc, letters, len(sizes))
            best = np.where(sizes > 0, won.argmax(1), n_langs)
            score = won.max(1) / np.maximum(every, 1)
            share = np.bincount(doc, letters * likely[ids], len(sizes)) / np.maximum(every, 1)
            first = np.concatenate([[0], np.cumsum(sizes)])
            change = np.flatnonzero(np.concatenate([[True], (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])]))
            ends = np.append(change[1:], len(labels))
            spans: list[list] = [[] for _ in sizes]
            for d, la, s, e in zip(doc[change].tolist(), langs[labels[change]].tolist(),
                                   (change - first[doc[change]]).tolist(), (ends - first[doc[change]]).tolist()):
                spans[d].append({"lang": la, "start": s, "end": e})
            return [langs[best].tolist(), score.tolist(), share.tolist(), spans]
        return compute
    return map_texts(docs, text, keep, OUT, make)


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` whose words are likely in some language (whichever it is) for at least ``least`` of their letters, the model
    fitted on ``docs`` itself. Keyboard junk and unseen languages go, mixed-language documents stay."""
    rows, text = numbered(docs)
    found = identify(rows, fit(docs), keep=rows.columns, text=text)
    return renamed_back(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("known") >= least)), docs.columns)
