"""M05, M07, M08 for many classes: a softmax model whose coefficients are a table.

MLlib's multinomial model is a dense features x classes matrix on the driver
with its optimiser's history. Here the coefficients are rows (model, shard,
frange, w): a shard is a range of ``width`` classes, an frange a range of
``span`` hashed features, so a row holds at most ``span * width`` numbers.
Documents are dealt once into tiles, sparse blocks of bounded size. A round
meets tiles and coefficients twice, by cogroups keyed by (model, shard, lane of
tiles): first each shard gives every document the maximum and the sum of its
exponentials (two numbers a shard, not one a class, are shuffled), which join
to the normaliser; then each lane sums its part of the gradient per feature
range, added up over the lanes in groups of bounded size.

A task holds one shard's coefficients and one lane of tiles. The driver holds
the class names and one loss per model and round. All models of a
regularisation grid train in the same passes. Every round is a stored table:
a restarted job goes on after the last complete one.

The steps are accelerated gradient steps scaled by the diagonal bound
1/2 * sum_d x_df * sum_f' x_df' of the Hessian, which needs no line search.

Beside the hashed words a document may bring a short dense vector of its own
(``vector_col``, e.g. the mean of its word vectors): its numbers are further
features of the same model (M06), trained and scored with the words.

Defined cases: a null text or one without tokens has the intercept alone (and its
vector); a null vector counts as zeros, one of another length ends the job; a class
seen only in scoring gets no score; no training rows, no model (ValueError);
a null label trains nothing; equal documents count each.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .. import constants as K
from ..session import run_folder
from ..sources.tables import path_exists
from .learn import tokenize

TILE_BYTES = 3 << 19
TILES_PER_LANE = 16
FAN_IN = 128
CHUNK_NUMBERS = 1 << 22
_TILE = "block int, ids array<{id}>, ys array<int>, sizes array<int>, features array<int>, weights array<double>"
_PART = "model int, shard int, frange int, lane int, g array<double>"
_COEFS = "model int, shard int, frange int, w array<double>, at array<double>"


@dataclass(frozen=True)
class Layout:
    """Features (``buckets``, the last ``extra`` of them the numbers of a document's own vector,
    the others hashed words; the intercept is one more), classes, and the sizes of a row's ranges."""
    buckets: int
    classes: int
    span: int = 256
    width: int = 32
    extra: int = 0

    @property
    def words(self) -> int:
        return self.buckets - self.extra

    @property
    def shards(self) -> int:
        return -(-self.classes // self.width)

    def columns(self, shard: int) -> int:
        return min(self.width, self.classes - shard * self.width)


@dataclass
class ShardedModel:
    coefs: DataFrame
    classes: list[str]
    layout: Layout
    regs: Sequence[float]
    rounds: int
    losses: list[tuple[int, int, float]] = field(default_factory=list)


def hashed(docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``hashes``, the bucket of every token: a batch's distinct tokens are hashed once each."""
    rows = tokenize(docs.withColumn(text_col, F.coalesce(F.col(text_col), F.lit(""))), text_col)
    kept = [f for f in rows.schema.fields if f.name not in (text_col, "tokens")]
    out = T.StructType([*kept, T.StructField("hashes", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            found = lists.flatten().dictionary_encode()
            of = np.array([int(hashlib.md5(w).hexdigest()[:8], 16) % buckets for w in found.dictionary.cast(pa.binary()).to_pylist()], np.int32)
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))]).astype(np.int32)
            hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(of[np.asarray(found.indices, dtype=np.int64)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], hashes], names=out.names)
    return rows.select(*[f.name for f in kept], "tokens").mapInArrow(run, out)


def tile_count(docs: DataFrame, text_col: str, tile_bytes: int) -> int:
    """Tiles of about ``tile_bytes`` of text each; no text is split into words for it."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 1)).first()[0] or 0
    return max(1, math.ceil(total / tile_bytes))


def make_tiles(rows: DataFrame, layout: Layout, id_col: str, blocks: int) -> DataFrame:
    """``blocks`` tiles of rows (id, y, hashes, vector).

    Values are counts scaled to length one per document, the vector as given
    and the intercept 1 beside them.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    beside = np.arange(layout.words, layout.buckets + 1, dtype=np.int32)     # the vector's features and the intercept

    def make(key, table):
        sizes, features, weights = [], [], []
        for hashes, vector in zip(table.column("hashes"), table.column("vector")):
            own = np.asarray(vector.values, dtype=float) if vector.is_valid else np.zeros(layout.extra)
            if len(own) != layout.extra:
                raise ValueError(f"a vector of {len(own)} numbers, not {layout.extra}")
            found, times = np.unique(np.asarray(hashes.values), return_counts=True)
            norm = math.sqrt(float((times.astype(float) ** 2).sum())) or 1.0
            sizes.append(len(found) + len(beside))
            features += [found.astype(np.int32), beside]
            weights += [times / norm, own, [1.0]]
        one = pa.table({"block": [key[0].as_py()], "ids": [table.column("id").to_pylist()], "ys": [table.column("y").to_pylist()],
                        "sizes": [sizes], "features": [np.concatenate(features).astype(np.int32)],
                        "weights": [np.concatenate(weights).astype(float)]})
        return one.cast(pa.schema([("block", pa.int32()), ("ids", pa.list_(table.schema.field("id").type)), ("ys", pa.list_(pa.int32())),
                                   ("sizes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32())),
                                   ("weights", pa.list_(pa.float64()))]))
    dealt = rows.select(F.col(id_col).alias("id"), F.col("y").cast("int").alias("y"), "hashes", "vector",
                        F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("block"))
    return dealt.groupBy("block").applyInArrow(make, _TILE.format(id=kind))


class _Tile:
    """One tile's arrays, and its features as rows of the coefficients at hand."""

    def __init__(self, row: dict, at: Sequence[int], span: int):
        self.block, self.ys = row["block"], row["ys"].astype(np.int64)
        self.sizes, self.values = row["sizes"].astype(np.int64), row["weights"]
        features = row["features"].astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        place = np.minimum(np.searchsorted(at, features // span), len(at) - 1)
        known = np.asarray(at)[place] == features // span
        self.rows = np.where(known, place * span + features % span, len(at) * span)

    def parts(self, columns: int):
        """(first document, last) of chunks of bounded work."""
        step = max(1, CHUNK_NUMBERS // columns)
        first = 0
        while first < len(self.sizes):
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + step, "right")) - 1)
            yield first, last
            first = last

    def logits(self, w: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.sizes), w.shape[1]))
        for a, b in self.parts(w.shape[1]):
            s, e = self.starts[a], self.starts[b]
            out[a:b] = np.add.reduceat(self.values[s:e, None] * w[self.rows[s:e]], self.starts[a:b] - s, axis=0)
        return out

    def add_gradient(self, total: np.ndarray, rest: np.ndarray) -> None:
        """``total`` plus, per row, values times ``rest`` (documents x classes)."""
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        for a, b in self.parts(rest.shape[1]):
            s, e = self.starts[a], self.starts[b]
            order = np.argsort(self.rows[s:e], kind="stable") + s
            rows, first = np.unique(self.rows[order], return_index=True)
            total[rows] += np.add.reduceat(self.values[order, None] * rest[doc[order]], first, axis=0)


def _rows(table: pa.Table | pa.RecordBatch):
    """The rows, their lists (but ids) as arrays."""
    columns = dict(zip(table.schema.names, table.columns))
    for i in range(table.num_rows):
        yield {c: np.asarray(v[i].values) if c != "ids" and pa.types.is_list(v.type) and v[i].is_valid else v[i].as_py()
               for c, v in columns.items()}


def _matrix(coefs: pa.Table, name: str, layout: Layout, columns: int) -> tuple[list[int], np.ndarray]:
    """(feature ranges in order, their coefficients above a row of zeros)."""
    held = sorted(zip(coefs.column("frange").to_pylist(), range(coefs.num_rows)))
    values = coefs.column(name)
    parts = [np.asarray(values[i].values).reshape(layout.span, columns) for _, i in held]
    return [r for r, _ in held], np.concatenate([*parts, np.zeros((1, columns))])


def _meet(tiles: DataFrame, coefs: DataFrame, layout: Layout, blocks: int, lane_size: int, work, schema: str) -> DataFrame:
    """``work(shard, model, lane, tiles, ranges, matrix)`` for every shard of every model and every lane of tiles.

    ``tiles`` come with a column ``model`` if they differ by it.
    """
    lanes = -(-blocks // lane_size)
    spread = tiles.withColumn("lane", F.floor(F.col("block") / lane_size).cast("int"))
    keys = ["model", "shard", "lane"]
    right = coefs.select("model", "shard", "frange", "at", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    spread = spread.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(layout.shards - 1))))

    def run(key, left, right):
        model, shard, lane = (k.as_py() for k in key)
        at, w = _matrix(right, "at", layout, layout.columns(shard)) if right.num_rows else ([0], np.zeros((layout.span + 1, layout.columns(shard))))
        return work(model, shard, lane, _rows(left), at, w)
    return spread.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


_NORMS = "model int, block int, shard int, top array<double>, total array<double>, own array<double>"


def normalisers(tiles: DataFrame, coefs: DataFrame, layout: Layout, blocks: int, lane_size: int, models: int) -> DataFrame:
    """(model, block, lse, loss, n): the log of each document's sum of exponentials, and the tile's summed log loss."""
    def part(model, shard, lane, rows, at, w):
        out: dict = {n: [] for n in ("model", "block", "shard", "top", "total", "own")}
        for row in rows:
            tile = _Tile(row, at, layout.span)
            z = tile.logits(w)
            top = z.max(axis=1)
            y = tile.ys - shard * layout.width
            mine = (y >= 0) & (y < z.shape[1])
            own = np.where(mine, z[np.arange(len(z)), np.where(mine, y, 0)], 0.0)
            for n, v in zip(out, (model, tile.block, shard, top, np.exp(z - top[:, None]).sum(axis=1), own)):
                out[n].append(v)
        return pa.table({n: pa.array(v, pa.list_(pa.float64()) if n in ("top", "total", "own") else pa.int32()) for n, v in out.items()})

    def join(key, table):
        order = np.argsort(table.column("shard").to_pylist())
        top, total, own = (np.stack([np.asarray(table.column(c)[int(i)].values) for i in order]) for c in ("top", "total", "own"))
        high = top.max(axis=0)
        lse = high + np.log((total * np.exp(top - high)).sum(axis=0))
        return pa.table({"model": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "lse": pa.array([lse], pa.list_(pa.float64())), "loss": [float((lse - own.sum(axis=0)).sum())],
                         "n": pa.array([len(lse)], pa.int64())})
    every = tiles.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(models - 1))))
    parts = _meet(every, coefs, layout, blocks, lane_size, part, _NORMS)
    return parts.groupBy("model", "block").applyInArrow(join, "model int, block int, lse array<double>, loss double, n long")


def _added(df: DataFrame, keys: list[str], lanes: int, fan: int = FAN_IN) -> DataFrame:
    """Sums of the arrays ``g`` by ``keys`` over the lanes, ``fan`` at a time."""
    fields = [f for f in df.schema.fields if f.name in (*keys, "lane", "g")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    def add(key, table):
        total = np.sum([np.asarray(v.values) for v in table.column("g")], axis=0)
        out = {k: pa.array([v.as_py()], pa.int32()) for k, v in zip([*keys, "lane"], key)}
        return pa.table({f.name: pa.array([total], pa.list_(pa.float64())) if f.name == "g" else out[f.name] for f in fields})
    while True:
        df = df.withColumn("lane", F.floor(F.col("lane") / fan).cast("int")).groupBy(*keys, "lane").applyInArrow(add, schema)
        lanes = -(-lanes // fan)
        if lanes == 1:
            return df.drop("lane")


def _ranges(at: Sequence[int], total: np.ndarray, span: int) -> list[tuple[int, np.ndarray]]:
    """The feature ranges of ``total`` that are not all zero."""
    blocks = total[:-1].reshape(len(at), span, -1)
    return [(at[i], blocks[i].ravel()) for i in np.flatnonzero(blocks.any(axis=(1, 2))).tolist()]


def curvature(tiles: DataFrame, layout: Layout, lanes: int) -> DataFrame:
    """(frange, g): half the sum over documents of |x_df| times the document's sum of them, per feature."""
    def part(batches):
        for batch in batches:
            for row in _rows(batch):
                at = np.unique(row["features"] // layout.span).tolist()
                tile = _Tile(row, at, layout.span)
                total = np.zeros((len(at) * layout.span + 1, 1))
                tile.values = np.abs(tile.values)
                tile.add_gradient(total, np.add.reduceat(tile.values, tile.starts[:-1])[:, None] / 2)
                for frange, g in _ranges(at, total, layout.span):
                    yield pa.RecordBatch.from_arrays([pa.array([frange], pa.int32()), pa.array([row["block"]], pa.int32()),
                                                      pa.array([g], pa.list_(pa.float64()))], names=["frange", "lane", "g"])
    return _added(tiles.mapInArrow(part, "frange int, lane int, g array<double>"), ["frange"], lanes)


def gradient(tiles: DataFrame, norms: DataFrame, coefs: DataFrame, layout: Layout, blocks: int, lane_size: int) -> DataFrame:
    """(model, shard, frange, g): the gradient of the summed log loss."""
    def part(model, shard, lane, rows, at, w):
        total = np.zeros_like(w)
        for row in rows:
            tile = _Tile(row, at, layout.span)
            rest = np.exp(tile.logits(w) - row["lse"][:, None])
            y = tile.ys - shard * layout.width
            mine = np.flatnonzero((y >= 0) & (y < rest.shape[1]))
            rest[mine, y[mine]] -= 1
            tile.add_gradient(total, rest)
        found = _ranges(at, total, layout.span)
        n = len(found)
        return pa.table({"model": pa.array([model] * n, pa.int32()), "shard": pa.array([shard] * n, pa.int32()),
                         "frange": pa.array([r for r, _ in found], pa.int32()), "lane": pa.array([lane] * n, pa.int32()),
                         "g": pa.array([g for _, g in found], pa.list_(pa.float64()))})
    parts = _meet(tiles.join(norms.select("model", "block", "lse"), "block"), coefs, layout, blocks, lane_size, part, _PART)
    return _added(parts, ["model", "shard", "frange"], -(-blocks // lane_size))


def _momentum(rounds_done: int) -> float:
    """The weight of the last step after so many rounds (1, 2, ...)."""
    t = 1.0
    for _ in range(rounds_done):
        last, t = t, (1 + math.sqrt(1 + 4 * t * t)) / 2
    return (last - 1) / t


def stepped(coefs: DataFrame, grads: DataFrame, bound: DataFrame, layout: Layout, regs: Sequence[float], n: int, beta: float) -> DataFrame:
    """The coefficients after one accelerated step; the intercept is not regularised."""
    joined = (coefs.join(grads, ["model", "shard", "frange"], "left").join(bound.withColumnRenamed("g", "d"), "frange")
              .select("model", "shard", "frange", "w", "at", "g", "d"))

    def run(batches):
        for batch in batches:
            ws, ats = [], []
            for row in _rows(batch):
                w, at = row["w"], row["at"]
                g = row["g"] if row["g"] is not None else np.zeros_like(w)
                reg = np.full(layout.span, regs[row["model"]])
                if row["frange"] == layout.buckets // layout.span:
                    reg[layout.buckets % layout.span] = 0.0
                columns = len(w) // layout.span
                slope = g / n + np.repeat(reg, columns) * at
                steep = np.repeat(row["d"] / n + reg, columns)
                new = at - np.divide(slope, steep, out=np.zeros_like(w), where=steep > 0)
                ws.append(new)
                ats.append(new + beta * (new - w))
            numbers = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ws, numbers), pa.array(ats, numbers)],
                                             names=["model", "shard", "frange", "w", "at"])
    return joined.mapInArrow(run, _COEFS)


def _kept(make, spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, written first if no complete one is there."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _vector(column: str | None) -> Column:
    return (F.col(column) if column else F.lit(None)).cast("array<double>").alias("vector")


def with_vectors(docs: DataFrame, parts: DataFrame, size: int, id_col: str = "doc_id", out: str = "vector") -> DataFrame:
    """``docs`` with the column ``out`` (array of ``size`` numbers) of ``parts``
    (id, pos from 0, x), as ``learn.mean_vectors`` gives them; what is not in ``parts`` is zero."""
    at = [F.sum(F.when(F.col("pos") == i, F.col("x")).otherwise(0.0)) for i in range(size)]
    vectors = parts.groupBy(id_col).agg(F.array(*at).alias(out))
    return docs.join(vectors, id_col, "left").withColumn(out, F.coalesce(out, F.array_repeat(F.lit(0.0), size)))


class Trainer:
    """Rounds of training over stored tiles, resumable in ``path`` (a folder of the shared checkpoint folder if not given)."""

    def __init__(self, docs: DataFrame, regs: Sequence[float] = (0.0,), buckets: int = 1 << 18, label_col: str = "true_label",
                 id_col: str = "doc_id", text_col: str = "text", path: str | None = None, span: int = 256, width: int = 32,
                 tile_bytes: int = TILE_BYTES, tiles_per_lane: int = TILES_PER_LANE, vector_col: str | None = None, vector_size: int = 0):
        self.spark, self.regs, self.id_col, self.text_col = docs.sparkSession, list(regs), id_col, text_col
        self.path = path or run_folder(self.spark, "softmax")
        self.lane_size = tiles_per_lane
        labelled = docs.where(F.col(label_col).isNotNull())
        self.classes = sorted(r[0] for r in labelled.select(label_col).distinct().collect())
        if not self.classes:
            raise ValueError("no labelled rows to train on")
        self.layout = Layout(buckets + vector_size, len(self.classes), span, width, vector_size)
        named = self.spark.createDataFrame(list(zip(self.classes, range(len(self.classes)))), f"`{label_col}` string, y int")
        rows = hashed(labelled.select(id_col, F.col(label_col).cast("string").alias(label_col), text_col, _vector(vector_col))
                      .join(F.broadcast(named), label_col), buckets, id_col, text_col)
        self.blocks = tile_count(labelled, text_col, tile_bytes)
        tiles = make_tiles(rows, self.layout, id_col, self.blocks)
        self.tiles = _kept(lambda: tiles, self.spark, f"{self.path}/tiles")
        self.n = self.tiles.agg(F.sum(F.size("ids"))).first()[0]
        self.bound = _kept(lambda: curvature(self.tiles, self.layout, self.blocks), self.spark, f"{self.path}/bound")
        self.done = 0
        while path_exists(self.spark, f"{self.path}/round-{self.done + 1}/_SUCCESS"):
            self.done += 1
        self.coefs = self.spark.read.parquet(f"{self.path}/round-{self.done}") if self.done else self._zero()
        self.losses: list[tuple[int, int, float]] = []

    def _zero(self) -> DataFrame:
        numbers = F.array_repeat(F.lit(0.0), F.lit(self.layout.span) * F.least(
            F.lit(self.layout.width), F.lit(self.layout.classes) - F.col("shard") * self.layout.width).cast("int"))
        rows = (self.bound.select("frange", F.explode(F.sequence(F.lit(0), F.lit(self.layout.shards - 1))).alias("shard"))
                .withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(self.regs) - 1)))))
        return rows.select("model", "shard", "frange", numbers.alias("w"), numbers.alias("at"))

    def round(self) -> None:
        k = self.done + 1
        norms = _kept(lambda: normalisers(self.tiles, self.coefs, self.layout, self.blocks, self.lane_size, len(self.regs)),
                      self.spark, f"{self.path}/norms-{k}")
        new = stepped(self.coefs, gradient(self.tiles, norms, self.coefs, self.layout, self.blocks, self.lane_size), self.bound,
                      self.layout, self.regs, self.n, _momentum(k))
        self.coefs = _kept(lambda: new, self.spark, f"{self.path}/round-{k}")
        self.losses += [(k, r["model"], r["loss"]) for r in
                        norms.groupBy("model").agg((F.sum("loss") / F.sum("n")).alias("loss")).collect()]
        self.done = k

    def model(self) -> ShardedModel:
        return ShardedModel(self.coefs, self.classes, self.layout, self.regs, self.done, list(self.losses))


def train(docs: DataFrame, rounds: int = 20, **settings) -> ShardedModel:
    """A model after ``rounds`` rounds (see ``Trainer`` for the settings)."""
    trainer = Trainer(docs, **settings)
    while trainer.done < rounds:
        trainer.round()
    return trainer.model()


def probabilities(model: ShardedModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tile_bytes: int = TILE_BYTES, tiles_per_lane: int = TILES_PER_LANE, vector_col: str | None = None) -> DataFrame:
    """(model, id, probs), the probability of every class in the order of ``model.classes``."""
    layout = model.layout
    rows = hashed(docs.select(id_col, text_col, F.lit(-1).alias("y"), _vector(vector_col)), layout.words, id_col, text_col)
    blocks = tile_count(docs, text_col, tile_bytes)
    tiles = make_tiles(rows, layout, id_col, blocks)
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def part(which, shard, lane, rows, at, w):
        out: dict = {n: [] for n in ("model", "block", "shard", "z", "ids")}
        for row in rows:
            tile = _Tile(row, at, layout.span)
            for n, v in zip(out, (which, tile.block, shard, tile.logits(w).ravel(), row["ids"])):
                out[n].append(v)
        types = {"z": pa.list_(pa.float64()), "ids": pa.list_(id_type)}
        return pa.table({n: pa.array(v, types.get(n, pa.int32())) for n, v in out.items()})

    def join(key, table):
        ids = table.column("ids")[0].as_py()
        order = np.argsort(table.column("shard").to_pylist())
        z = np.concatenate([np.asarray(table.column("z")[int(i)].values).reshape(len(ids), -1) for i in order], axis=1)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return pa.table({"model": pa.array([key[0].as_py()] * len(ids), pa.int32()), "id": pa.array(ids, id_type),
                         "probs": pa.array(list(p), pa.list_(pa.float64()))})
    every = tiles.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(model.regs) - 1))))
    final = model.coefs.select("model", "shard", "frange", F.col("w").alias("at"))
    parts = _meet(every, final, layout, blocks, tiles_per_lane, part,
                  f"model int, block int, shard int, z array<double>, ids array<{kind}>")
    return (parts.groupBy("model", "block").applyInArrow(join, f"model int, id {kind}, probs array<double>")
            .withColumnRenamed("id", id_col))


def weights(model: ShardedModel) -> DataFrame:
    """(model, feature, label, w) in long form; feature ``buckets`` is the intercept."""
    columns = F.least(F.lit(model.layout.width), F.lit(model.layout.classes) - F.col("shard") * model.layout.width)
    feature = F.col("frange") * model.layout.span + F.floor(F.col("pos") / columns)
    place = F.col("shard") * model.layout.width + F.col("pos") % columns
    names = F.array(*[F.lit(c) for c in model.classes])
    return (model.coefs.select("model", "shard", "frange", F.posexplode("w").alias("pos", "w"))
            .select("model", feature.cast("int").alias("feature"), F.get(names, place).alias("label"), "w"))


def score_map(model: ShardedModel, probs: DataFrame) -> DataFrame:
    """The probabilities as the evaluation takes them: ``scores`` {code: probability}."""
    codes = F.array(*[F.lit(c) for c in model.classes])
    return probs.withColumn("scores", F.map_from_arrays(codes, "probs")).drop("probs")


def dev_scores(model: ShardedModel, dev: DataFrame, label_col: str = "true_label", id_col: str = "doc_id",
               text_col: str = "text", threshold: float = K.DECISION_THRESHOLD) -> DataFrame:
    """(model, macro_f, accuracy) on labelled documents: F per class of the codes that reach ``threshold``, averaged over the classes."""
    names = F.array(*[F.lit(c) for c in model.classes])
    top = F.array_position("probs", F.array_max("probs")).cast("int")
    told = (probabilities(model, dev, id_col, text_col).join(dev.select(id_col, F.col(label_col).alias("gold")), id_col)
            .select("model", "gold", (F.element_at(names, top) == F.col("gold")).cast("int").alias("right"),
                    F.filter(F.transform("probs", lambda p, i: F.when(p >= threshold, F.get(names, i))), lambda c: c.isNotNull()).alias("codes")))
    hits = told.select("model", "gold", F.explode("codes").alias("code"))
    said = hits.groupBy("model", "code").agg(F.count(F.lit(1)).alias("said"), F.sum((F.col("code") == F.col("gold")).cast("long")).alias("tp"))
    gold = told.groupBy("model", F.col("gold").alias("code")).agg(F.count(F.lit(1)).alias("gold"), F.sum("right").alias("right"))
    both = said.join(gold, ["model", "code"], "full").fillna(0)
    f = 2 * F.col("tp") / (F.col("said") + F.col("gold"))
    return both.groupBy("model").agg((F.sum(f) / len(model.classes)).alias("macro_f"),
                                     (F.sum("right") / F.sum("gold")).alias("accuracy"))


def train_with_dev(train_docs: DataFrame, dev: DataFrame, regs: Sequence[float], rounds: int = 20, every: int = 5, patience: int = 2,
                   label_col: str = "true_label", id_col: str = "doc_id", text_col: str = "text",
                   **settings) -> tuple[ShardedModel, int, DataFrame]:
    """All models of the grid trained together and scored on ``dev`` every ``every`` rounds.

    Training stops when ``patience`` checks in a row brought no better macro F
    of any model. Returns the state of the best check, the best model's number
    in it and a table (round, model, reg, dev_macro_f, dev_accuracy). The
    checks done are stored beside the rounds, so a restart repeats none.
    """
    trainer = Trainer(train_docs, regs, label_col=label_col, id_col=id_col, text_col=text_col, **settings)
    spark, checks, best, idle = trainer.spark, [], None, 0
    for k in range(every, rounds + 1, every):
        while trainer.done < k:
            trainer.round()
        coefs = spark.read.parquet(f"{trainer.path}/round-{k}")
        state = ShardedModel(coefs, trainer.classes, trainer.layout, trainer.regs, k)
        stored = _kept(lambda: dev_scores(state, dev, label_col, id_col, text_col), spark, f"{trainer.path}/check-{k}")
        found = sorted((r["model"], r["macro_f"], r["accuracy"]) for r in stored.collect())
        checks += [(k, m, float(regs[m]), f, a) for m, f, a in found]
        top = max(found, key=lambda x: (x[1], -x[0]))
        if best is None or top[1] > best[2]:
            best, idle = (state, top[0], top[1]), 0
        else:
            idle += 1
        if idle >= patience:
            break
    table = spark.createDataFrame(checks, "round int, model int, reg double, dev_macro_f double, dev_accuracy double")
    return best[0], best[1], table
