"""Operator 5: MinHash near-dedup with tensored banding and verified links.

A document's set is its distinct five-word shingles, hashed to 64 bits. Two
small collections of ``SIDE`` signatures are computed, each of ``ROWS``
minhashes; a table's key pairs one signature of the first collection with one
of the second. So 2 * SIDE * ROWS minhashes give SIDE * SIDE tables of keys of
2 * ROWS minhashes each, about the square root of what independent tables
would compute.

Equal sets are collapsed to one representative. A bucket proposes its members
against its smallest one; proposals are confirmed on the full sets. What the
confirmed links have not joined yet in a bucket is compared across the parts:
buckets that share a part form a group, and all its documents outside its
largest part are compared with all its documents, in blocks, by counting
shared shingles over an inverted index. So every pair that shares a bucket is
either joined or refuted; copies are never expanded into pairs.

Defined cases: a text with fewer words than a shingle has its whole sequence
as one; null, empty and wordless texts have an empty set and link with
nothing; a null doc_id links with nothing (component null, kept true); rows
sharing a doc_id are one node of the links, whose texts all count; no rows,
no rows; input columns named like an output column are replaced by it.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .groups import flat_lists, map_sorted_groups
from .storage import broadcast_checked, stored
from .textmap import map_texts
from .words import whitespace_words

SHINGLE, PERCENT = 5, 75
SIDE, ROWS, SEED = 8, 2, 11
CACHED_WORDS, BLOCK = 1 << 20, 1024
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; hashes of recent words are kept."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.known: dict[bytes, int] = {}

    def shingles(self, text: bytes | None) -> np.ndarray:
        words = whitespace_words(text)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(words))
        if not size:
            return hashes
        total = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            total = total * _STEP + hashes[i:len(words) - size + 1 + i]
        return np.unique(_mix(total))


def signatures(hashes: np.ndarray, side: int = SIDE, rows: int = ROWS, seed: int = SEED) -> np.ndarray:
    """2 * side signatures of ``rows`` minhashes each."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 1 << 63, size=(2, 2 * side * rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    lows = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)]
        for i in range(len(a)):
            lows[i] = min(lows[i], (part * a[i] + b[i]).min())
    out = np.zeros(2 * side, dtype=np.uint64)
    for r in range(rows):
        out = _mix(out * _STEP + lows[r::rows])
    return out.view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    """(id, n_shingles, digest, sigs) per row of (id, text)."""
    def make():
        shingler = Shingler()

        def compute(texts, _):
            n, digests, sigs = [], [], []
            for text in texts:
                hashes = shingler.shingles(text)
                n.append(len(hashes))
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                sigs.append(signatures(hashes).tolist() if len(hashes) else None)
            return [n, digests, sigs]
        return compute
    return map_texts(docs, "text", ["id"], "n_shingles long, digest binary, sigs array<long>", make)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(id, shingles) per row of (id, text)."""
    def make():
        shingler = Shingler()
        return lambda texts, _: [[shingler.shingles(t).view(np.int64) for t in texts]]
    return map_texts(docs, "text", ["id"], "shingles array<long>", make)


def table_keys(sigs: Column, side: int = SIDE) -> Column:
    """The key of every pair of signatures, one of each collection."""
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda i: F.transform(
        F.sequence(F.lit(side), F.lit(2 * side - 1)), lambda j: F.xxhash64(i, j, F.get(sigs, i), F.get(sigs, j)))))


def sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """A stored table (id, shingles) of the documents whose id is in the column ``of`` of a stored table."""
    some = docs.join(broadcast_checked(ids), F.col("id") == F.col("of"), "left_semi")
    return stored(shingle_sets(some).distinct(), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the distinct (a, b) whose full sets reach ``percent`` % Jaccard similarity, as a stored table."""
    pairs = stored(pairs.distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("of")).unionByName(pairs.select(F.col("b").alias("of"))).distinct()
    sets = sets_of(stored(ids, "pair_ids"), docs)
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    near = 100 * both >= percent * (F.size("x") + F.size("y") - both)
    # no distinct() here: on the join's own key it would keep adaptive execution from splitting a hot ``b``
    return stored(pairs.join(left, "a").join(right, "b").where(near & (F.size("x") > 0)).select("a", "b"), "links")


def joined_parts(parts: np.ndarray, sides: np.ndarray, sets: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Distinct pairs of different parts with a link between a document of side 0 and any document of the block."""
    _, shingle = np.unique(sets, return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(shingle, kind="stable")
    held = owner[order]
    bounds = np.searchsorted(shingle[order], np.arange(shingle.max(initial=-1) + 2))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    found = []
    for d in np.flatnonzero(sides == 0).tolist():
        own = shingle[starts[d]:starts[d + 1]]
        low, many = bounds[own], bounds[own + 1] - bounds[own]
        at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        both = np.bincount(held[at], minlength=len(sizes))
        near = (100 * both >= percent * (sizes[d] + sizes - both)) & (parts != parts[d])
        found += [(min(p, parts[d]), max(p, parts[d])) for p in np.unique(parts[near]).tolist()]
    return np.unique(np.array(found, dtype=np.int64).reshape(-1, 2), axis=0)


def across_parts(rest: DataFrame, docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between parts of torn buckets, from the stored (bucket, rep, part)."""
    low = rest.groupBy("bucket").agg(F.min("part").alias("least"))
    near = rest.join(stored(low.withColumnRenamed("bucket", "torn"), "least_parts"), F.col("bucket") == F.col("torn"))
    groups = stored(components(near.select("part", "least"), "part", "least")
                    .select(F.col("id").alias("in"), F.col("component_id").alias("grp")), "groups")
    members = stored(rest.select("rep", "part").distinct().join(groups, F.col("part") == F.col("in")).select("grp", "rep", "part"),
                     "group_members")
    sizes = members.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"))  # a row per part
    best = Window.partitionBy("grp").orderBy(F.desc("n"), "part")
    whole = (sizes.withColumn("at", F.row_number().over(best)).groupBy(F.col("grp").alias("of_grp"))
             .agg(F.max(F.when(F.col("at") == 1, F.col("part"))).alias("main"),
                  F.coalesce(F.sum(F.when(F.col("at") > 1, F.col("n"))), F.lit(0)).alias("n_few"),
                  F.max(F.when(F.col("at") == 1, F.col("n"))).alias("n_main")))
    sized = members.join(stored(whole, "group_sizes"), F.col("grp") == F.col("of_grp"))
    few = F.ceil(F.col("n_few") / block).cast("int")
    many = F.ceil(F.col("n_main") / block).cast("int")
    is_few = F.col("part") != F.col("main")
    chunk = F.pmod(F.xxhash64("rep"), F.when(is_few, few).otherwise(many)).cast("int")
    # a block is (chunk i of the few, chunk j of the few with i <= j) or (chunk i of the few, -1 - chunk j of the main part)
    blocks = F.when(is_few, F.concat(
        F.transform(F.sequence(F.lit(0), few - 1), lambda k: F.struct(
            F.least(chunk, k).alias("i"), F.greatest(chunk, k).alias("j"), F.when(chunk <= k, 0).otherwise(1).alias("side"))),
        F.transform(F.sequence(F.lit(0), many - 1), lambda k: F.struct(chunk.alias("i"), (-1 - k).alias("j"), F.lit(0).alias("side")))
    )).otherwise(F.transform(F.sequence(F.lit(0), few - 1), lambda k: F.struct(
        k.alias("i"), (-1 - chunk).alias("j"), F.lit(1).alias("side"))))
    sets = sets_of(stored(members.select(F.col("rep").alias("of")).distinct(), "torn_ids"), docs)
    dealt = (sized.select("grp", "rep", "part", F.explode(blocks).alias("b")).select("grp", "b.i", "b.j", "b.side", "rep", "part")
             .join(sets, F.col("rep") == F.col("id")).select("grp", "i", "j", "side", "part", "shingles"))

    def work(t: pa.Table):
        values, sizes = flat_lists(t, "shingles")
        pairs = joined_parts(np.asarray(t.column("part")), np.asarray(t.column("side")), values, sizes, percent)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return stored(map_sorted_groups(dealt, ["grp", "i", "j"], work, "a long, b long"), "part_links")


def classes(signed: DataFrame, docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(id, component_id) of all ids that link with another; ``signed`` is the stored table of ``sign``."""
    usable = signed.where("id is not null and n_shingles > 0")
    reps = stored(usable.groupBy("digest").agg(F.min("id").alias("rep"), F.first("sigs").alias("sigs")), "distinct_sets")
    copies = (usable.join(reps.select("digest", "rep"), "digest").where("id != rep")
              .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    keys = reps.select("rep", F.explode(table_keys(F.col("sigs"))).alias("key"))
    shared = stored(keys.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
                    .select(F.col("key").alias("bucket"), "low"), "shared_buckets")
    members = stored(keys.join(shared, F.col("key") == F.col("bucket")).select("bucket", "rep", "low"), "members")
    stars = confirmed(members.where("rep != low").select(F.col("rep").alias("a"), F.col("low").alias("b")), docs, percent)
    parts = stored(components(stars, "a", "b").withColumnRenamed("id", "of"), "parts")
    placed = stored(members.join(parts, F.col("rep") == F.col("of"), "left")
                    .select("bucket", "rep", F.coalesce("component_id", "rep").alias("part")), "placed")
    torn = stored(placed.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
                  .select(F.col("bucket").alias("torn")), "torn_buckets")
    rest = stored(placed.join(torn, F.col("bucket") == F.col("torn")).select("bucket", "rep", "part"), "torn_members")
    links = across_parts(rest, docs, percent, block)
    return components(stars.unionByName(links).unionByName(copies), "a", "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    signed = stored(sign(slim), "signatures")
    found = stored(classes(signed, slim, percent).withColumnRenamed("id", "of"), "classes")
    component = F.coalesce("component_id", "id")
    return (signed.join(broadcast_checked(found), F.col("id") == F.col("of"), "left")
            .select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; of rows sharing an id one stays."""
    slim = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    signed = stored(sign(slim), "signatures")
    found = stored(classes(signed, slim, percent).where("id != component_id").select(F.col("id").alias("copy")), "copies")
    again = stored(signed.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select(F.col("id").alias("again")), "repeated_ids")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"))
    first = row.join(broadcast_checked(found), F.col("id") == F.col("copy"), "left_anti")
    twice = broadcast_checked(again)
    return (first.join(twice, F.col("id") == F.col("again"), "left_anti").select("row.*")
            .unionByName(first.join(twice, F.col("id") == F.col("again"), "left_semi").dropDuplicates(["id"]).select("row.*")))
