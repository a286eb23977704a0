"""Groups of rows as runs of a sorted partition, a batch at a time, for groups of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def grouped(df: DataFrame, *keys: str) -> DataFrame:
    """`df` with the rows of each value of `keys` in one partition, one after the other."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def starts_of_runs(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Row numbers at which a value of `keys` begins, with the number of rows at the end."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def whole_runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole runs only, with the starts of the runs; a run may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        starts = starts_of_runs(table, keys)
        last = int(starts[-2])
        if last:
            yield table.slice(0, last), starts[:-1]
            held = table.slice(last).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, starts_of_runs(table, keys)
