"""Operator 12: toxicity by compression distance with zstandard dictionaries.

Two dictionaries are trained. The ordinary one on texts labelled 0; the toxic
one on the toxic passages of texts labelled 1, laid before the ordinary
content, since toxic texts are ordinary prose but for those passages. So the
two compressors differ by the toxic passages alone. A text is compressed in
windows of ``WINDOW`` words with each; a window's gain is the number of bytes
that the toxic dictionary saves. Shares of windows at several gains, weighed
by a logistic fit on labelled rows that trained no dictionary, give the
score; 0.5 stands at the cut that served those rows best.

Passages: of the distinct (word before, word, word after) triples of each
class, byte n-grams within a word that are ``RATIO`` times as frequent in
toxic ones with a G-test of at least ``LEAST_G`` are marked; stretches of
marked bytes are passages. Triples are counted once however often a text was
copied.

Training reads at most about ``SAMPLE_BYTES`` of text a class, chosen by the
document's hash; texts above ``LONGEST`` bytes are left out of it. Scoring
reads every text whole, in pieces of bounded size.

Defined cases: null and empty texts have no window and score as a text
without gains; a null ``doc_id`` counts as the empty string in the folds and
is joined to no label; rows whose label is neither 0 nor 1 train nothing;
without labelled rows of both classes every score is the share of toxic ones
(0 without any); repeated rows score alike; malformed bytes are compressed as
they are; an empty table gives no rows; input columns named like an output
column are replaced by it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit import pieces
from .storage import broadcast_checked, stored
from .textmap import map_texts

FOLDS, HELD_OUT = 5, 0
CALIBRATION = 4
SAMPLE_BYTES, LONGEST = 4 << 20, 256 << 10
WINDOW = 8
ORDINARY_BYTES, TOXIC_BYTES = 32 << 10, 16 << 10
NGRAMS = (4, 5, 6, 7, 8)
RATIO, LEAST_G, LEAST_SEEN = 3, 25.0, 3
LEVEL = 13
GAINS = (1, 2, 3, 4)
RIDGE = 1.0
MANY_WINDOWS = 1 << 15
OUT = "score double, predicted int, passages array<struct<start:long,end:long,gain:int>>"
#: stands before every window and at the end of both dictionaries, so that each block pays for compression
CARRIER = bytes(range(0x01, 0x09)) + bytes(range(0x0E, 0x1E))


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) % FOLDS == HELD_OUT


def window_lists(text: bytes) -> Iterator[list[bytes]]:
    """The text's windows, whole words each, some thousands at a time; pieces change none of them."""
    rest: list[bytes] = []
    for piece in pieces(text):
        words = rest + piece.lower().split()
        whole = len(words) - len(words) % WINDOW
        for at in range(0, whole, WINDOW * MANY_WINDOWS):
            yield [b" %b " % b" ".join(words[i:i + WINDOW]) for i in range(at, min(at + WINDOW * MANY_WINDOWS, whole), WINDOW)]
        rest = words[whole:]
    if rest:
        yield [b" %b " % b" ".join(rest)]


class Compressor:
    """Lengths of (one or more) windows compressed with a dictionary of plain content."""

    def __init__(self, content: bytes):
        content = content + CARRIER
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, dict_size=len(content), source_size=128, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        held.precompute_compress(compression_params=settings)
        self.compressor = zstandard.ZstdCompressor(dict_data=held, compression_params=settings)

    def lengths(self, windows: Sequence[bytes]) -> np.ndarray:
        done = self.compressor.multi_compress_to_buffer([CARRIER + w for w in windows], threads=1)
        return np.fromiter((len(done[i]) for i in range(len(done))), dtype=np.int64, count=len(done))


def train_dictionary(samples: Sequence[bytes], size: int, segment: int) -> bytes:
    """Content that zstandard's trainer chooses; the samples themselves where they are too few to train on."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, total), list(samples), split_point=1.0, d=6, k=segment, steps=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def distinct_triples(texts: Sequence[bytes]) -> Counter:
    """How many distinct (word before, word, word after) each word stands in."""
    place: dict[bytes, int] = {b"": 0}
    parts = []
    for text in texts:
        ids = np.array([0, *[place.setdefault(w, len(place)) for w in text.lower().split()], 0], dtype=np.uint64)
        mixed = (ids[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ ids[2:]) * np.uint64(0xBF58476D1CE4E5B9) ^ ids[1:-1]
        parts.append(np.stack([mixed, ids[1:-1]], axis=1))
    if not parts:
        return Counter()
    middle = np.unique(np.concatenate(parts), axis=0)[:, 1].astype(np.int64)
    times = np.bincount(middle, minlength=len(place))
    return Counter({w: int(times[i]) for w, i in place.items() if times[i]})


def _grams(word: bytes) -> set[bytes]:
    return {word[i:i + n] for n in NGRAMS for i in range(len(word) - n + 1)}


def _g_test(a: int, n: int, b: int, m: int) -> float:
    """G of ``a`` of ``n`` against ``b`` of ``m``."""
    def part(k: int, size: int) -> float:
        p = (a + b) / (n + m)
        return sum(x * math.log(x / (size * q)) for x, q in ((k, p), (size - k, 1 - p)) if x)
    return 2 * (part(a, n) + part(b, m))


def toxic_passages(toxic: Sequence[bytes], ordinary: Sequence[bytes]) -> list[bytes]:
    """Distinct stretches of words that toxic texts use more, the most frequent first."""
    words = distinct_triples(toxic), distinct_triples(ordinary)
    counts = []
    for seen in words:
        grams: Counter = Counter()
        for w, times in seen.items():
            for g in _grams(b" %b " % w):
                grams[g] += times
        counts.append(grams)
    n, m = (max(1, sum(w.values())) for w in words)
    marked = {g for g, a in counts[0].items() if a >= LEAST_SEEN and a * m > RATIO * counts[1][g] * n
              and _g_test(a, n, counts[1][g], m) >= LEAST_G}
    found: Counter = Counter()
    for w, times in words[0].items():
        word = b" %b " % w
        if marked.isdisjoint(_grams(word)):
            continue
        inside = np.zeros(len(word) + 2, dtype=np.int8)
        for size in NGRAMS:
            for i in range(len(word) - size + 1):
                if word[i:i + size] in marked:
                    inside[i + 1:i + size + 1] = 1
        edges = np.flatnonzero(np.diff(inside)).tolist()
        for start, end in zip(edges[::2], edges[1::2]):
            found[word[start:end]] += times
    return [p for p, _ in sorted(found.items(), key=lambda x: (-x[1], x[0]))]


def features(gains: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document the mean gain and the share of its windows at each gain of ``GAINS``."""
    windows = np.maximum(np.bincount(doc, minlength=n_docs), 1)
    return np.stack([np.bincount(doc, gains, n_docs), *[np.bincount(doc, gains >= g, n_docs) for g in GAINS]], axis=1) / windows[:, None]


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Ridge logistic weights by Newton's steps, the constant last."""
    rows = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([RIDGE] * x.shape[1] + [1e-6])
    w = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = _sigmoid(rows @ w)
        w -= np.linalg.solve((rows * (p * (1 - p) + 1e-9)[:, None]).T @ rows + ridge, rows.T @ (p - y) + ridge @ w)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The value between two rows at which taking the rows above as toxic gives the highest F1.

    At least half of them must be toxic; where no cut achieves it none is taken.
    """
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    hits, taken = np.cumsum(y), np.arange(1, len(y) + 1)
    open_ = np.append(z[1:] != z[:-1], True) & (2 * hits >= taken)
    f1 = np.where(open_, 2 * hits / (taken + y.sum()), -1)
    at = int(f1.argmax())
    if f1[at] < 0:
        return float(z[0]) + 1.0
    return float((z[at] + z[at + 1]) / 2) if at + 1 < len(z) else float(z[at]) - 1e-9


@dataclass
class Model:
    """Two dictionaries, the scale of the features and the fitted weights; without dictionaries a constant score."""
    constant: float = 0.0
    ordinary: bytes = b""
    toxic: bytes = b""
    scale: np.ndarray = field(default_factory=lambda: np.ones(1 + len(GAINS)))
    weights: np.ndarray | None = None

    def gains(self, compressors: tuple[Compressor, Compressor], windows: Sequence[bytes]) -> np.ndarray:
        return compressors[0].lengths(windows) - compressors[1].lengths(windows)

    def compressors(self) -> tuple[Compressor, Compressor]:
        return Compressor(self.ordinary), Compressor(self.toxic + self.ordinary)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid((x / self.scale) @ self.weights[:-1] + self.weights[-1])


def document_gains(texts: Sequence[bytes], model: Model, compressors: tuple[Compressor, Compressor]) -> tuple[np.ndarray, np.ndarray]:
    """(gain, document) of every window of the texts."""
    gains, doc, held, held_doc = [], [], [], []

    def flush() -> None:
        if held:
            gains.append(model.gains(compressors, held))
            doc.append(np.array(held_doc, dtype=np.int64))
            held.clear()
            held_doc.clear()
    for i, text in enumerate(texts):
        for windows in window_lists(text):
            held += windows
            held_doc += [i] * len(windows)
            if len(held) >= MANY_WINDOWS:
                flush()
    flush()
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *gains]), np.concatenate([none, *doc])


def train(toxic: Sequence[bytes], ordinary: Sequence[bytes], rows: Sequence[tuple[bytes, int]]) -> Model:
    """Dictionaries from texts of either class, weights from the other labelled ``rows`` (text, label)."""
    labels = np.array([y for _, y in rows], dtype=np.int64)
    if not toxic or not ordinary:
        seen = labels.sum() + len(toxic)
        return Model(float(seen / max(1, len(labels) + len(toxic) + len(ordinary))))
    model = Model(ordinary=train_dictionary([b" %b " % b" ".join(t.lower().split()) for t in ordinary], ORDINARY_BYTES, 16),
                  toxic=train_dictionary(toxic_passages(toxic, ordinary) * 2, TOXIC_BYTES, 64))
    if len(set(labels.tolist())) < 2:
        rows = [(t, 1) for t in toxic] + [(t, 0) for t in ordinary]
        labels = np.array([y for _, y in rows], dtype=np.int64)
    gains, doc = document_gains([t for t, _ in rows], model, model.compressors())
    x = features(gains, doc, len(rows))
    model.scale = np.maximum(x.std(axis=0), 1e-6)
    model.weights = _logistic(x / model.scale, labels)
    model.weights[-1] -= best_cut((x / model.scale) @ model.weights[:-1] + model.weights[-1], labels)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> list[tuple[bytes, int, bool]]:
    """(text, label, whether it calibrates) of a sample of at most about ``sample_bytes`` a class and use.

    Rows are chosen on ids and sizes alone, by a hash of the id below the share
    that the class's bytes allow; only the chosen texts leave their place.
    """
    marked = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    uses = ["toxic", "calibrates"]
    sizes = stored(docs.where(~held_out(F.col("doc_id"))).select("doc_id", F.octet_length("text").alias("size"))
                   .where(F.col("size").between(1, LONGEST)).join(marked, "doc_id")
                   .select("doc_id", "size", "toxic", (F.floor(fold(F.col("doc_id")) / FOLDS) % CALIBRATION == 0).alias("calibrates"),
                           F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)).alias("draw")), "toxicity-sizes")
    taken = F.lit(False)
    for r in sizes.groupBy(*uses).agg(F.sum("size").alias("n")).collect():
        below = F.col("draw") < math.ceil(min(1.0, sample_bytes / r["n"]) * (1 << 20))
        taken = taken | ((F.col("toxic") == r["toxic"]) & (F.col("calibrates") == r["calibrates"]) & below)
    sample = broadcast_checked(stored(sizes.where(taken).select("doc_id", *uses).distinct(), "toxicity-sample"))
    rows = (docs.where(~held_out(F.col("doc_id")) & F.octet_length("text").between(1, LONGEST)).join(sample, "doc_id")
            .select(F.col("text").cast("binary").alias("text"), *uses).collect())
    return sorted((bytes(r["text"]), r["toxic"], r["calibrates"]) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model of the labelled rows that are not held out."""
    rows = training_rows(docs, labels, sample_bytes)
    return train([t for t, y, c in rows if y == 1 and not c], [t for t, y, c in rows if y == 0 and not c],
                 [(t, y) for t, y, c in rows if c])


def score_toxicity(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), least: int = GAINS[1]) -> DataFrame:
    """``keep`` columns plus score, predicted and passages: windows (word places, end exclusive) of at least ``least`` gained bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        compressors = model.compressors() if model.weights is not None else None

        def compute(texts, _):
            if compressors is None:
                return [[model.constant] * len(texts), [int(model.constant >= 0.5)] * len(texts), [[] for _ in texts]]
            gains, doc = document_gains([t or b"" for t in texts], model, compressors)
            score = model.scores(features(gains, doc, len(texts)))
            first = np.searchsorted(doc, np.arange(len(texts)))
            found: list[list] = [[] for _ in texts]
            for w in np.flatnonzero(gains >= least).tolist():
                at = int(w - first[doc[w]]) * WINDOW
                found[doc[w]].append({"start": at, "end": at + WINDOW, "gain": int(gains[w])})
            return [score, (score >= 0.5).astype(np.int32), found]
        return compute
    return map_texts(docs, "text", keep, OUT, make)
