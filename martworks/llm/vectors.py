"""Vectors of a list column as integer rows, and sums over all tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite entry."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (
        F.abs(x.cast("double")) != float("inf"))), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, all lists of the same length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def rows_of(values: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, np.ascontiguousarray(values).ravel())


def summed(parts: DataFrame, column: str, kind: str) -> list:
    """Sum of equally long lists, entry by entry: what comes to the driver is one list, however many rows there are."""
    out = parts.where(F.col(column).isNotNull()).select(F.posexplode(column).alias("k", "v")).groupBy("k").agg(
        F.sum(F.col("v").cast(kind)).alias("v")).collect()
    return [r.v for r in sorted(out, key=lambda r: r.k)]


def task_sum(add) -> callable:
    """A ``mapInArrow`` function that gives one row ``total`` for each task: the sum of ``add(batch)`` over its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = add(batch)
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(total.dtype)))], ["total"])

    return run
