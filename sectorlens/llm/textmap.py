"""Map whole texts in Arrow batches of bounded size, passing chosen columns through."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK_BYTES = 16 << 20


def chunks(batch: pa.RecordBatch, texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batch with about ``limit`` bytes of text each (a longer text has its own)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start), texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start), texts.slice(start)


def map_texts(df: DataFrame, text: str, keep: Sequence[str], out: str,
              make: Callable[[], Callable[[list[bytes | None], pa.RecordBatch], list[Sequence]]]) -> DataFrame:
    """``keep`` columns of ``df`` plus the columns of the DDL ``out``, one row per row.

    ``make()`` runs once per task and gives ``compute(texts, rows)``, which
    returns the values of each new column for a chunk of rows. A kept column
    named like a new one gives way to it.
    """
    added = StructType.fromDDL(out)
    kept = [c for c in keep if c not in added.names]
    at = kept.index(text) if text in kept else len(kept)
    read = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept if text in kept else [*kept, text])])
    schema = StructType(read.schema.fields[:len(kept)] + added.fields)

    def run(batches):
        compute = make()
        types = None
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            types = types or _arrow(added)
            for rows, part in chunks(batch, texts):
                made = compute(part.to_pylist(), rows)
                arrays = [rows.column(i) for i in range(len(kept))]
                arrays += [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    done = read.mapInArrow(run, schema)
    return done.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], *added.names)


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with columns c0, c1, ... (no new column's name can clash), and the new name of its text column."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), f"c{df.columns.index('text')}"


def renamed_back(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def _arrow(schema: StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    return [to_arrow_type(f.dataType) for f in schema.fields]
