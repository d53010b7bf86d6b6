"""Operator 1: embedding near-dedup by cross-polytope hashing.

A vector is padded to a power of two and rotated by three rounds of random
signs and a fast Hadamard transform; the axis with the largest coordinate,
with its sign, is one hash. ``hashes`` of them make a bucket of a table, and
a vector also probes the buckets that differ in one hash by its second
largest axis. Two vectors meet in every bucket that both have, own or probed.
The number of hashes follows the number of vectors (a bucket holds a
bounded number of unrelated ones on average); the number of tables then
follows from the wanted recall at the threshold, found by a fixed simulation
of the meetings of an own with any bucket (those of two probes come on top).

Equal vectors are collapsed first. Buckets are worked through in sorted
order; a bucket above ``BLOCK`` rows is cut into chunks, and every pair of
chunks is a group of its own. Within a group all pairs are compared by cosine
in double precision, but only counts per vector and its group's smallest
connected id are emitted. A pair that meets several times is counted in the
smallest shared bucket of the first table with one, which both codes tell.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor do vectors of different lengths or with a
null id (component null, kept true); components of any finite size count, as
vectors are scaled by a power of two first; rows with equal id and vector link with
each other; links of rows sharing an id are summed over the id; no vectors,
no rows; input columns named like an output column are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .groups import flat_lists, map_sorted_groups
from .storage import broadcast_checked, stored

THRESHOLD, RECALL, OCCUPANCY, BLOCK, SEED = 0.9, 0.995, 32, 1024, 7


@dataclass(frozen=True)
class Scheme:
    """Random rotations for vectors of one length."""
    dim: int
    hashes: int
    tables: int
    seed: int = SEED

    @property
    def width(self) -> int:
        return 1 << max(1, (self.dim - 1).bit_length())

    @lru_cache(maxsize=4096)
    def signs(self, table: int, i: int) -> np.ndarray:
        rng = np.random.default_rng([self.seed, self.dim, table, i])
        return rng.choice([-1.0, 1.0], size=(3, self.width))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """rows x tables x (1 + hashes): the own bucket, then the probed ones."""
        padded = np.zeros((len(vectors), self.width))
        padded[:, :self.dim] = scaled(vectors)
        out = np.empty((len(vectors), self.tables, 1 + self.hashes), dtype=np.int64)
        for t in range(self.tables):
            axes = [top_axes(rotate(padded, self.signs(t, i))) for i in range(self.hashes)]
            for p in range(1 + self.hashes):
                code = np.zeros(len(vectors), dtype=np.int64)
                for i, (first, second) in enumerate(axes):
                    code = code * (2 * self.width) + (second if p == i + 1 else first)
                out[:, t, p] = code
        return out


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows whose largest component lies in [0.5, 1): a power of two each, so that nothing is rounded."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def hadamard(rows: np.ndarray) -> np.ndarray:
    n, half = rows.shape[1], 1
    while half < n:
        pairs = rows.reshape(len(rows), -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
        half *= 2
    return rows


def rotate(rows: np.ndarray, signs: np.ndarray) -> np.ndarray:
    for s in signs:
        rows = hadamard(rows * s) / math.sqrt(rows.shape[1])
    return rows


def top_axes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two largest axes by absolute coordinate, each as 2 * axis + sign."""
    size = np.abs(rows)
    at = np.arange(len(rows))
    first = size.argmax(1)
    size[at, first] = -1
    second = size.argmax(1)
    return 2 * first + (rows[at, first] < 0), 2 * second + (rows[at, second] < 0)


@lru_cache(maxsize=64)
def scheme_for(dim: int, n: int, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = SEED) -> Scheme:
    """Hashes for ``n`` vectors, and tables so that pairs at the threshold meet with probability ``recall``."""
    axes = 2 * Scheme(dim, 1, 1).width
    hashes = max(1, math.ceil(math.log(max(n / OCCUPANCY, 1.1)) / math.log(axes)))
    rng = np.random.default_rng([seed, dim])
    x, y = rng.normal(size=(2, 1000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    trial = Scheme(dim, hashes, 4, seed + 1)
    a, b = trial.codes(x), trial.codes(threshold * x + math.sqrt(1 - threshold ** 2) * y)
    met = (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)
    rate = min(0.999, max(0.001, float(met.mean())))
    return Scheme(dim, hashes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - rate))), seed)


def meets(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of code rows: in which tables they share a bucket, and the smallest shared bucket there."""
    shared = (a[:, :, :, None] == b[:, :, None, :]).any(3)
    return shared.any(2), np.where(shared, a, np.iinfo(np.int64).max).min(2)


def group_links(ids, weights, vectors, table: int, bucket: int, scheme: Scheme, sides, threshold: float):
    """(row, smallest connected id, weighted links counted here) of the linked rows of a group.

    ``sides``: chunk of each row; if there are two, only pairs across them
    are this group's. Pairs are compared in strips of bounded size.
    """
    n = len(ids)
    unit = scaled(vectors)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    across = sides.min() != sides.max()
    left, right = [], []
    for at in range(0, n, 256):
        close = unit[at:at + 256] @ unit.T >= threshold
        i, j = np.nonzero(close)
        i += at
        ok = (ids[i] < ids[j]) & ((sides[i] != sides[j]) if across else True)
        left.append(i[ok])
        right.append(j[ok])
    i, j = np.concatenate(left), np.concatenate(right)
    if not len(i):
        return None
    root = ids.copy()
    while True:  # smallest id over the links, until nothing changes
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            break
    used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    codes = scheme.codes(vectors[used])
    counts = np.zeros(n, dtype=np.int64)
    for at in range(0, len(i), 1 << 15):
        a, b = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
        met, where = meets(codes[back[at:at + len(a)]], codes[back[len(i) + at:len(i) + at + len(a)]])
        t = met.argmax(1)
        here = met.any(1) & (t == table) & (where[np.arange(len(a)), t] == bucket)
        np.add.at(counts, a[here], weights[b[here]])
        np.add.at(counts, b[here], weights[a[here]])
    return used, root[used], counts[used]


def distinct_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(embedding, rep, copies): usable vectors with the smallest id and number of their rows."""
    e = F.col("embedding")
    usable = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(e, lambda x: x != 0)
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"))
            .where(F.col("id").isNotNull() & e.isNotNull() & F.coalesce(usable, F.lit(False)))
            .groupBy("embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))


def _bucket_rows(reps: DataFrame, schemes: dict[int, Scheme]) -> DataFrame:
    """A row per vector and bucket: (dim, tbl, bucket, rep, copies, embedding)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sizes = np.asarray(batch.column(0).value_lengths())
                for dim in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == dim)
                    part = batch.take(pa.array(rows))
                    scheme = schemes[dim]
                    codes = scheme.codes(np.asarray(part.column(0).flatten(), dtype=np.float64).reshape(-1, dim))
                    per = codes.shape[1] * codes.shape[2]
                    for some in range(0, len(rows), 200):  # the copies of a slice at a time
                        n = min(200, len(rows) - some)
                        take = pa.array(np.repeat(np.arange(some, some + n), per))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(n * per, dim, np.int32)),
                            pa.array(np.tile(np.repeat(np.arange(codes.shape[1], dtype=np.int32), codes.shape[2]), n)),
                            pa.array(codes[some:some + n].reshape(-1)), part.column(1).take(take), part.column(2).take(take),
                            part.column(0).take(take)], names=["dim", "tbl", "bucket", "rep", "copies", "embedding"])
    kind = dict(reps.dtypes)["embedding"]
    return reps.select("embedding", "rep", "copies").mapInArrow(
        run, f"dim int, tbl int, bucket long, rep long, copies long, embedding {kind}")


def links(reps: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """A stored table (id, root, n): partial counts of linked copies per id, and ids connected to it."""
    sizes = {r[0]: r[1] for r in reps.groupBy(F.size("embedding")).count().collect()}  # a row per vector length
    schemes = {d: scheme_for(d, n, threshold) for d, n in sizes.items()}
    rows = _bucket_rows(reps, schemes)
    key = ["dim", "tbl", "bucket"]
    slim = _bucket_rows(reps, schemes).select(*key)
    full = stored(slim.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > block), "full_buckets")
    parts = F.ceil(F.coalesce(F.col("m"), F.lit(1)) / block).cast("int")
    chunk = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    dealt = (rows.join(broadcast_checked(full), key, "left").withColumn("parts", parts).withColumn("chunk", chunk)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(*key, F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"), "chunk",
                     "rep", "copies", "embedding"))
    group = [*key, "low", "high"]

    def work(t: pa.Table):
        if t.num_rows < 2:
            return
        dim, tbl, bucket, low, high = (t.column(c)[0].as_py() for c in group)
        chunk = np.asarray(t.column("chunk"))
        if low != high and chunk.min() == chunk.max():
            return
        ids = np.asarray(t.column("rep"))
        vectors = flat_lists(t, "embedding")[0].astype(np.float64).reshape(-1, dim)
        found = group_links(ids, np.asarray(t.column("copies")), vectors, tbl, bucket, schemes[dim], chunk, threshold)
        if found:
            used, root, count = found
            yield pa.RecordBatch.from_arrays([pa.array(ids[used]), pa.array(root), pa.array(count)], names=["id", "root", "n"])
    return stored(map_sorted_groups(dealt, group, work, "id long, root long, n long"), "vector_links")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """All columns of ``vectors`` plus n_links, component_id, kept."""
    made = ("n_links", "component_id", "kept")
    reps = stored(distinct_vectors(vectors, id_col, vector_col), "distinct_vectors")
    found = links(reps, threshold, block)
    classes = components(found, "id", "root")
    counted = found.groupBy("id").agg(F.sum("n").alias("n")).join(classes, "id", "left")
    known = stored(reps.join(counted, F.col("rep") == F.col("id"), "left").select(
        F.col("embedding").alias("shared"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component_id", "rep").alias("component")), "vector_classes")
    row = vectors.select(F.struct(*[F.col(f"`{c}`") for c in vectors.columns if c not in made]).alias("row"),
                         F.col(id_col).cast("long").alias("id"), F.when(F.col(id_col).isNotNull(), F.col(vector_col)).alias("vector"))
    component = F.coalesce("component", "id")
    return (row.join(known, F.col("vector") == F.col("shared"), "left")
            .select("row.*", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                    F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))


