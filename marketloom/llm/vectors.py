"""What the operators on embeddings share: which vectors count, and sums over all of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not zero, no null and no non-finite component."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    whole = vector.cast("array<double>")
    return F.coalesce(
        F.forall(whole, lambda x: F.coalesce(finite(x), F.lit(False)))
        & F.exists(whole, lambda x: x != 0),
        F.lit(False),
    )


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Arrays of numbers as rows of doubles; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    values = np.asarray(column.flatten(), dtype=np.float64)
    if len(values) == len(lengths) * width and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    out[rows, np.arange(len(values)) - np.repeat(starts, lengths)] = values
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def width(vectors: DataFrame, column: str) -> int:
    """The largest number of components; 0 for an empty table."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def summed(vectors: DataFrame, column: str, size: int, of, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all vectors of `of(matrix)`, an array of `shape`, added up by the cluster.

    A task sends one row per component of the array, whatever the number of its vectors.
    """
    cells = int(np.prod(shape))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += of(matrix(batch.column(0), size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(cells)), pa.array(total.ravel())], ["cell", "total"]
        )

    parts = vectors.select(column).mapInArrow(partial, "cell long, total double")
    rows = parts.groupBy("cell").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(cells)
    for cell, total in rows:
        out[cell] = total
    return out.reshape(shape)


def dot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added from the first component to the last."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total
