"""Vector columns: which rows can be compared, and sorted groups of rows in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec as array<double>) of rows with an id and a vector that is not null, zero or empty and holds finite numbers only.

    If an id is repeated, its greatest vector counts.
    """
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull())
        .where(fine & F.exists("vec", lambda x: x != 0))
        .groupBy("id")
        .agg(F.max("vec").alias("vec"))
    )


def matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """Rows of a list column of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False)


def bytes_matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of a binary column of equal length."""
    if not len(column):
        return np.zeros((0, 0), kind)
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1)


def bytes_column(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], solve: Callable[[pa.Table, np.ndarray], pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """``solve`` on tables of whole groups, with the groups' first rows; the input is sorted by ``keys``."""
    held: pa.Table | None = None

    def starts(table: pa.Table) -> np.ndarray:
        fresh = np.zeros(table.num_rows, bool)
        fresh[0] = True
        for key in keys:
            column = table[key].to_numpy()
            fresh[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(fresh)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        first = starts(held)
        if len(first) > 1:
            yield solve(held.slice(0, first[-1]).combine_chunks(), first[:-1])
            held = held.slice(first[-1])
    if held is not None and held.num_rows:
        yield solve(held.combine_chunks(), starts(held))


def plain(table: pa.Table, name: str) -> pa.Array:
    """A column in one piece."""
    column = table[name]
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)
