"""Operator 9: language-model scores from sharded Elias-Fano bigram tries.

Documents are packed once, where they are read, into stored chunks of token
numbers with the chunk's vocabulary as 64-bit word hashes. Every chunk sends
each shard its distinct bigrams whose context falls there (contexts by hash;
the few that hold a large share of all tokens are spread over all shards by
bigram), with their counts in training documents. A shard, of bounded size,
sums the counts, builds its trie and answers every chunk: the count of each
context and a quantised code of each bigram. Chunks then score their documents.

The trie has two levels in one buffer: sorted context hashes and their counts,
monotone pointers into the second level, and there the successors of each
context, as 40-bit fingerprints made monotone by the context's place, with an
8-bit code each. A bigram is found by its context's place and a successor
search relative to it. The code is the logarithm of LAMBDA * c(v w) / c(v); the
probability of w after v is that plus (1 - LAMBDA) times the unigram
probability of w, or the latter alone if v was not seen in training.

Defined cases: null and empty texts have one token, the end; a null doc_id
counts as the empty string in the fold and stays null; without training
documents all counts are 0; every row gives one row, repeated rows alike.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .eliasfano import EliasFano
from .groups import map_sorted_groups
from .storage import stored
from .textmap import chunks
from .words import whitespace_words

FOLDS, HELD_OUT = 5, 1
LAMBDA = 0.7
SHARD_TOKENS, CHUNK_BYTES = 1 << 20, 8 << 20
LEAST_SHARE = 2.0 ** -20
FINGER_BITS = 40
LOWEST = -9.0  # logarithm of code 1; code 255 is 0, code 0 means unseen
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)  # hashes of the marks around a text


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(*arrays: np.ndarray) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data) -> tuple:
    data = memoryview(data)
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))


# ---- the trie ------------------------------------------------------------------------------------------------------

def quantised(share: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(1 + (np.log10(share) - LOWEST) * (254 / -LOWEST)), 1, 255).astype(np.uint8)


def probability(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (LOWEST + (code.astype(np.float64) - 1) * (-LOWEST / 254)), 0.0)


class Trie:
    """Two levels over one buffer, which may be memory-mapped."""

    def __init__(self, buffer):
        self.contexts = EliasFano(buffer)
        n = self.contexts.n
        self.counts = np.frombuffer(buffer, np.uint64, n, self.contexts.end)
        self.pointers = EliasFano(buffer, self.contexts.end + 8 * n)
        self.successors = EliasFano(buffer, self.pointers.end)
        self.codes = np.frombuffer(buffer, np.uint8, self.successors.n, self.successors.end)

    @staticmethod
    def build(contexts: np.ndarray, counts: np.ndarray, owner: np.ndarray, fingers: np.ndarray, times: np.ndarray,
              totals: np.ndarray) -> bytes:
        """From sorted distinct ``contexts`` with ``counts``, and their bigrams sorted by (owner, finger).

        ``totals`` are the contexts' counts over all shards, by which the bigrams' probabilities divide.
        """
        bounds = np.searchsorted(owner, np.arange(len(contexts) + 1))
        made = (owner.astype(np.uint64) << np.uint64(FINGER_BITS)) | fingers
        codes = quantised(LAMBDA * times / totals[owner])
        return b"".join([EliasFano.encode(contexts, 1 << 64), counts.astype(np.uint64).tobytes(),
                         EliasFano.encode(bounds, len(owner) + 1),
                         EliasFano.encode(made, max(1, len(contexts)) << FINGER_BITS), codes.tobytes()])

    def count(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each context or -1, its count)."""
        place, found = self.contexts.successor(contexts)
        place = np.where(found, place, -1)
        counts = np.zeros(len(place), dtype=np.int64)
        counts[found] = self.counts[place[found]]
        return place, counts

    def code(self, place: np.ndarray, fingers: np.ndarray) -> np.ndarray:
        """The code of each (context's place, successor), 0 if unseen; searched within the context's range."""
        codes = np.zeros(len(place), dtype=np.uint8)
        known = np.flatnonzero(place >= 0)
        if len(known) and self.successors.n:
            p = place[known]
            at, equal = self.successors.successor((p.astype(np.uint64) << np.uint64(FINGER_BITS)) | fingers[known])
            equal &= (at >= self.pointers.get(p).astype(np.int64)) & (at < self.pointers.get(p + 1).astype(np.int64))
            codes[known[equal]] = self.codes[at[equal]]
        return codes


# ---- chunks of documents -------------------------------------------------------------------------------------------

def pack_documents(docs: DataFrame) -> DataFrame:
    """A stored table of chunks: ids and folds of their documents, and one blob of sizes, tokens and word hashes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), held_out(F.col("doc_id")).alias("held"),
                       F.col("text").cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, batch.column(2), CHUNK_BYTES):
                vocabulary: dict[bytes, int] = {}
                tokens, sizes = [], []
                for text in texts.to_pylist():
                    words = whitespace_words(text)
                    tokens += [vocabulary.setdefault(w, len(vocabulary)) for w in words]
                    sizes.append(len(words))
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), dtype=np.uint64, count=len(vocabulary))
                sizes = np.array(sizes, dtype=np.int32)
                held = np.array(part.column(1).to_pylist(), dtype=bool)
                blob = packed(sizes, np.array(tokens, dtype=np.int32), hashes, held)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([blob], pa.binary()),
                    pa.array([int((sizes + 1)[~held].sum())], pa.int64()), pa.array([int((~held).sum())], pa.int64())],
                    names=["ids", "blob", "train_tokens", "train_docs"])
    done = rows.mapInArrow(run, "ids array<long>, blob binary, train_tokens long, train_docs long")
    return stored(done.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


class Chunk:
    """Token pairs of a chunk and their places in the shards; the same each time it is opened."""

    def __init__(self, blob, hot: np.ndarray, n_shards: int):
        sizes, tokens, hashes, held = unpacked(blob)
        n = len(hashes)
        self.hashes = np.concatenate([hashes, [START, END]])
        self.sizes, self.held = sizes, held
        after = np.cumsum(sizes.astype(np.int64) + 1) - 1  # where each document's end stands
        self.next = np.empty(len(tokens) + len(sizes), dtype=np.int64)
        is_end = np.zeros(len(self.next), dtype=bool)
        is_end[after] = True
        self.next[is_end] = n + 1
        self.next[~is_end] = tokens
        before = np.empty_like(self.next)
        before[1:] = self.next[:-1]
        before[after - sizes] = n
        self.doc = np.repeat(np.arange(len(sizes)), sizes.astype(np.int64) + 1)
        pairs, self.pair = np.unique(before * (n + 2) + self.next, return_inverse=True)
        self.times = np.bincount(self.pair, ~held[self.doc], len(pairs)).astype(np.int64)
        v, w = pairs // (n + 2), pairs % (n + 2)
        mixed = _mix(self.hashes[v])
        spread = np.isin(self.hashes[v], hot)
        mixed[spread] = _mix(mixed[spread] ^ self.hashes[w[spread]])
        shard = (mixed % np.uint64(n_shards)).astype(np.int64)
        self.order = np.argsort(shard, kind="stable")  # pairs by shard, then context, then successor
        self.v, self.w, self.shard = v[self.order], w[self.order], shard[self.order]
        first = np.ones(len(self.v), dtype=bool)
        first[1:] = (self.v[1:] != self.v[:-1]) | (self.shard[1:] != self.shard[:-1])
        self.first = np.flatnonzero(first)  # where each context of a shard begins

    def questions(self):
        """(shard, blob) for every shard that this chunk has pairs in."""
        fingers = _mix(self.hashes[self.w]) >> np.uint64(64 - FINGER_BITS)
        times = self.times[self.order]
        runs = np.diff(np.append(self.first, len(self.v)))
        at = 0
        for s, begin in zip(*np.unique(self.shard[self.first], return_index=True)):
            stop = np.searchsorted(self.shard[self.first], s, "right")
            size = int(runs[begin:stop].sum())
            part = slice(at, at + size)
            at += size
            yield int(s), packed(self.hashes[self.v[self.first[begin:stop]]], runs[begin:stop].astype(np.uint32),
                                 (fingers[part] & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                                 (fingers[part] >> np.uint64(32)).astype(np.uint8), times[part].astype(np.uint32))


def hot_contexts(packed_docs: DataFrame, n_shards: int, n_tokens: int) -> dict[int, int]:
    """Exact training counts of the contexts above a share of the tokens; at most 2 / share of them.

    A context with twice the share of all tokens has the share in enough chunks to be found from these alone.
    """
    share = max(1 / (64 * n_shards), LEAST_SHARE)

    def counted(batches, wanted=None):
        for batch in batches:
            for blob in batch.column(0):
                sizes, tokens, hashes, held = unpacked(blob.as_buffer())
                train = np.repeat(~held, sizes)
                counts = np.bincount(tokens[train], minlength=len(hashes))
                keep = np.isin(hashes, wanted) if wanted is not None else counts >= max(1, share / 4 * len(tokens))
                yield pa.RecordBatch.from_arrays([pa.array(hashes[keep].view(np.int64)), pa.array(counts[keep].astype(np.int64))],
                                                 names=["h", "n"])
    local = packed_docs.select("blob").mapInArrow(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    hot = np.array([r[0] for r in local.where(F.col("n") >= share / 2 * n_tokens).select("h").collect()], dtype=np.int64)
    wanted = hot.view(np.uint64)
    exact = (packed_docs.select("blob").mapInArrow(lambda b: counted(b, wanted), "h long, n long")
             .groupBy("h").agg(F.sum("n").alias("n")))
    return {int(np.int64(h).view(np.uint64)): n for h, n in exact.collect()}


def answer_shard(blobs: list, hot_keys: np.ndarray, hot_counts: np.ndarray) -> tuple[int, list[bytes]]:
    """(distinct training words among the shard's own contexts, an answer per chunk)."""
    asked = [unpacked(b) for b in blobs]
    fingers = [lo.astype(np.uint64) | (hi.astype(np.uint64) << np.uint64(32)) for _, _, lo, hi, _ in asked]
    trained = [t > 0 for *_, t in asked]
    v = np.concatenate([np.repeat(c, r)[m] for (c, r, *_), m in zip(asked, trained)])
    w = np.concatenate([f[m] for f, m in zip(fingers, trained)])
    times = np.concatenate([t[m] for (*_, t), m in zip(asked, trained)]).astype(np.int64)
    order = np.lexsort((w, v))
    v, w, times = v[order], w[order], times[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    at = np.flatnonzero(new)
    times = np.add.reduceat(times, at) if len(at) else times
    v, w = v[at], w[at]
    contexts, owner = np.unique(v, return_inverse=True)
    counts = np.bincount(owner, times, len(contexts)).astype(np.int64)
    place = np.searchsorted(hot_keys, contexts)
    place[place == len(hot_keys)] = 0
    is_hot = hot_keys[place] == contexts if len(hot_keys) else np.zeros(len(contexts), dtype=bool)
    totals = np.where(is_hot, hot_counts[place], counts) if len(hot_keys) else counts
    trie = Trie(Trie.build(contexts, counts, owner, w, times, totals))
    answers = []
    for (c, runs, *_), f in zip(asked, fingers):
        found, n = trie.count(c)
        answers.append(packed(n, trie.code(np.repeat(found, runs), f)))
    own = int((~is_hot & (contexts != START)).sum())
    return own, answers


def score_documents(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs`` (doc_id, text)."""
    whole = pack_documents(docs)
    n_tokens, n_docs = whole.agg(F.coalesce(F.sum("train_tokens"), F.lit(0)), F.coalesce(F.sum("train_docs"), F.lit(0))).first()
    n_shards = max(1, -(-n_tokens // shard_tokens))
    hot = hot_contexts(whole, n_shards, n_tokens) if n_tokens else {}
    hot[int(START)] = n_docs
    hot_keys = np.array(sorted(hot), dtype=np.uint64)
    hot_counts = np.array([hot[int(k)] for k in hot_keys], dtype=np.int64)
    shared = whole.sparkSession.sparkContext.broadcast((hot_keys, hot_counts))

    def ask(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                for shard, question in Chunk(blob.as_buffer(), shared.value[0], n_shards).questions():
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([chunk], pa.int64()),
                                                      pa.array([question], pa.binary())], names=["shard", "chunk", "blob"])

    def answer(t: pa.Table):
        shard = t.column("shard")[0].as_py()
        own, answers = answer_shard([b.as_buffer() for b in t.column("blob")], *shared.value)
        for i, (chunk, blob) in enumerate(zip(t.column("chunk").to_pylist(), answers)):
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([shard], pa.int64()), pa.array([blob], pa.binary()),
                pa.array([own if i == 0 else 0], pa.int64())], names=["chunk", "shard", "blob", "own"])
    asked = whole.select("chunk", "blob").mapInArrow(ask, "shard long, chunk long, blob binary")
    answers = stored(map_sorted_groups(asked, ["shard"], answer, "chunk long, shard long, blob binary, own long"), "answers")
    n_words = answers.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    distinct = n_words + sum(n > 0 for k, n in hot.items() if k != int(START)) + (n_docs > 0)

    def finish(t: pa.Table):
        mine = [i for i, s in enumerate(t.column("shard").to_pylist()) if s < 0]
        chunk = Chunk(t.column("blob")[mine[0]].as_buffer(), shared.value[0], n_shards)
        others = sorted((s, i) for i, s in enumerate(t.column("shard").to_pylist()) if s >= 0)
        replies = [unpacked(t.column("blob")[i].as_buffer()) for _, i in others]
        count, code = (np.concatenate([r[k] for r in replies]) for k in (0, 1))
        base, score, known = chunk_scores(chunk, count, code, hot_keys, hot_counts, n_tokens, n_docs, distinct)
        ids = t.column("ids")[mine[0]].as_py()
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(chunk.held), pa.array(chunk.sizes.astype(np.int64) + 1), pa.array(known),
            pa.array(np.full(len(ids), n_tokens, np.int64)), pa.array(base), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    both = (whole.select("chunk", F.lit(-1).cast("long").alias("shard"), "blob", "ids")
            .unionByName(answers.select("chunk", "shard", "blob", F.lit(None).cast("array<long>").alias("ids"))))
    return map_sorted_groups(both, ["chunk"], finish, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                             "train_tokens long, base_score double, score double")


def chunk_scores(chunk: Chunk, count, code, hot_keys, hot_counts, n_tokens: int, n_docs: int, distinct: int):
    """(base score, model score, known tokens) of a chunk's documents, from all shards' answers in order."""
    counts = np.zeros(len(chunk.hashes), dtype=np.int64)
    counts[chunk.v[chunk.first]] = count
    place = np.minimum(np.searchsorted(hot_keys, chunk.hashes), len(hot_keys) - 1)
    is_hot = hot_keys[place] == chunk.hashes
    counts[is_hot] = hot_counts[place[is_hot]]
    counts[-1] = n_docs  # every training text ends once
    unigram = (counts + 0.5) / (n_tokens + 0.5 * (distinct + 1))
    p = probability(code) + np.where(counts[chunk.v] > 0, 1 - LAMBDA, 1.0) * unigram[chunk.w]
    logs = np.empty(len(p))
    logs[chunk.order] = np.log10(p)
    n = len(chunk.sizes)
    base = np.bincount(chunk.doc, np.log10(unigram)[chunk.next], n)
    known = np.bincount(chunk.doc, counts[chunk.next] > 0, n).astype(np.int64)
    return base, np.bincount(chunk.doc, logs[chunk.pair], n), known
