"""Operator 6: benchmark decontamination with a document-sharded positional index.

Documents are indexed where they are read: each task keeps, for a chunk of
whole texts, the positions of every benchmark term (an inverted index by
shards of documents, so no posting is ever shuffled). The benchmark is the
query set; it is sent in blocks of bounded size. A window of consecutive item
words is looked up from its rarest term: the lists of the next rarest terms,
shifted by their offsets, are intersected with it until none or all are left.
The same postings answer proximity, for every window too: all its terms
within ``near`` words of its rarest one, in any order.

Defined cases: a null or wordless text has no words and no hits; an item
without words has no window, one shorter than a window is a window itself; an
item whose id is null marks words but is not listed; repeated items count
once; an empty benchmark gives rows without hits; input columns named like
an output column are replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from .textmap import map_texts, numbered, renamed_back
from .words import alnum_words

WINDOW = 10
NEAR = 20
BLOCK_BYTES = 8 << 20
OUT = ("n_words long, n_hit long, n_items long, n_near long, items array<string>, items_sha256 string, contaminated boolean, "
       "near_items array<string>")


class Queries:
    """Distinct windows of a block of items, with the items that have them."""

    def __init__(self, items: Sequence[tuple[str | None, list[bytes]]], window: int):
        self.terms: dict[bytes, int] = {}
        exact: dict[tuple[int, ...], set] = {}
        apart: dict[tuple[int, ...], set] = {}
        for item, words in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words]
            size = min(window, len(ids))
            if not size:
                continue
            for i in range(len(ids) - size + 1):
                exact.setdefault(tuple(ids[i:i + size]), set()).add(item)
                apart.setdefault(tuple(sorted(set(ids[i:i + size]))), set()).add(item)
        self.exact = [(np.array(w), sorted(x for x in s if x is not None)) for w, s in exact.items()]
        self.apart = [(np.array(w), sorted(x for x in s if x is not None)) for w, s in apart.items()]


class Shard:
    """Positions of the query terms in a chunk of documents."""

    def __init__(self, tokens: np.ndarray, n_terms: int):
        at = np.flatnonzero(tokens >= 0)
        at = at[np.argsort(tokens[at], kind="stable")]
        self.at = at
        self.bounds = np.searchsorted(tokens[at], np.arange(n_terms + 1))
        self.counts = np.diff(self.bounds)
        self.pairs: dict[tuple[int, int, int], np.ndarray] = {}

    def postings(self, term: int) -> np.ndarray:
        return self.at[self.bounds[term]:self.bounds[term + 1]]

    def followed(self, found: np.ndarray, term: int, shift: int) -> np.ndarray:
        """The positions of ``found`` that have ``term`` ``shift`` words on."""
        other = self.postings(term)
        place = np.searchsorted(other, found + shift)
        place[place == len(other)] = 0
        return found[other[place] == found + shift]

    def phrase(self, window: np.ndarray) -> np.ndarray:
        """Starts of all exact matches, intersecting from the rarest term."""
        counts = self.counts[window]
        if not counts.all():
            return self.at[:0]
        order = np.argsort(counts, kind="stable")
        first = int(order[0])
        found = self.postings(window[first])
        for n, o in enumerate(order[1:].tolist()):
            term, shift = int(window[o]), o - first
            if n == 0:  # windows of an item share their rarest pair
                key = (int(window[first]), term, shift)
                if key not in self.pairs:
                    self.pairs[key] = self.followed(found, term, shift)
                found = self.pairs[key]
            else:
                found = self.followed(found, term, shift)
            if not len(found):
                break
        return found - first

    def near(self, terms: np.ndarray, slack: int) -> np.ndarray:
        """Positions of the rarest term with every other term at most ``slack`` words away."""
        counts = self.counts[terms]
        if not counts.all():
            return self.at[:0]
        order = np.argsort(counts, kind="stable")
        found = self.postings(terms[order[0]])
        for o in order[1:]:
            other = self.postings(terms[o])
            place = np.searchsorted(other, found - slack)
            last = place == len(other)
            place[last] = 0
            found = found[~last & (other[place] <= found + slack)]
            if not len(found):
                break
        return found


def search(documents: list[list[bytes]], blocks: Sequence[Queries], near: int):
    """Per document: mask of hit words, items matched exactly, items matched nearby."""
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + near + 1)])[:-1].astype(np.int64)
    hits = np.zeros(int(sizes.sum() + (near + 1) * len(sizes)) + 1, dtype=np.int64)
    exact: list[set] = [set() for _ in documents]
    close: list[set] = [set() for _ in documents]
    for queries in blocks:
        tokens = np.full(len(hits), -1, dtype=np.int32)
        get = queries.terms.get
        for words, start in zip(documents, starts.tolist()):
            tokens[start:start + len(words)] = [get(w, -1) for w in words]
        shard = Shard(tokens, len(queries.terms))
        for window, items in queries.exact:
            found = shard.phrase(window)
            if len(found):
                hits[found] += 1
                hits[found + len(window)] -= 1
                for d in np.unique(np.searchsorted(starts, found, "right") - 1).tolist():
                    exact[d].update(items)
        for terms, items in queries.apart:
            found = shard.near(terms, near)
            for d in np.unique(np.searchsorted(starts, found, "right") - 1).tolist():
                close[d].update(items)
    return starts, np.cumsum(hits) > 0, exact, close


def query_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcasts of the items' windows, each of at most ``block_bytes`` of text (or one longer item)."""
    spark = benchmark.sparkSession
    blocks, items, held = [], [], 0
    for item, text in benchmark.selectExpr("cast(item_id as string)", "cast(text as binary)").toLocalIterator():
        size = len(text or b"")
        if held and held + size > block_bytes:
            blocks.append(spark.sparkContext.broadcast(Queries(items, window)))
            items, held = [], 0
        items.append((item, alnum_words(bytes(text or b""))))
        held += size
    if items:
        blocks.append(spark.sparkContext.broadcast(Queries(items, window)))
    return blocks


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",), window: int = WINDOW,
               near: int = NEAR, block_bytes: int = BLOCK_BYTES, text: str = "text") -> DataFrame:
    """``keep`` columns plus n_words, n_hit, n_items, n_near, items, items_sha256, contaminated, near_items.

    ``near_items`` are the n_near items matched exactly or nearby.
    """
    blocks = query_blocks(benchmark, window, block_bytes)

    def make():
        def compute(texts, _):
            documents = [alnum_words(t) for t in texts]
            starts, hit, exact, close = search(documents, [b.value for b in blocks], near)
            n_hit = [int(hit[s:s + len(d)].sum()) for s, d in zip(starts.tolist(), documents)]
            items = [sorted(x) for x in exact]
            nearby = [sorted(x | y) for x, y in zip(exact, close)]
            return [[len(d) for d in documents], n_hit, [len(x) for x in items], [len(x) for x in nearby], items,
                    [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], [n > 0 for n in n_hit], nearby]
        return compute
    return map_texts(docs, text, keep, OUT, make)


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    rows, text = numbered(docs)
    found = find_leaks(rows, benchmark, keep=rows.columns, text=text)
    return renamed_back(found.where("not contaminated"), docs.columns)
