"""Work on groups of rows in sorted partitions, one group at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def map_sorted_groups(df: DataFrame, keys: Sequence[str], work: Callable[[pa.Table], Iterable[pa.RecordBatch]],
                      schema: str) -> DataFrame:
    """``work`` on each group of equal integer ``keys``; many small groups share a task without a call of Spark's each.

    A task holds one group and one Arrow batch; callers bound the groups.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartition(n, *keys).sortWithinPartitions(*keys)

    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            values = np.stack([np.asarray(table.column(c)) for c in keys], axis=1)
            if held and any(held[0].column(c)[0] != table.column(c)[0] for c in keys):
                yield from work(pa.concat_tables(held))
                held = []
            start = 0
            for cut in (np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1).tolist():
                yield from work(pa.concat_tables([*held, table.slice(start, cut - start)]))
                held, start = [], cut
            held.append(table.slice(start))
        if held:
            yield from work(pa.concat_tables(held))
    return ordered.mapInArrow(run, schema)


def flat_lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(all values, lengths) of a list column."""
    chunks = table.column(name).chunks
    return (np.concatenate([np.asarray(c.flatten()) for c in chunks]),
            np.concatenate([np.asarray(c.value_lengths()) for c in chunks]))
