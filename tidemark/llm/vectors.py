"""Vectors in Arrow batches, and lists of the best of each query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: str, key: str, nonzero: bool = False) -> Column:
    """Rows with an id and a vector without null, NaN or infinite components; if asked for, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad
    return fine & F.exists(vector, lambda x: x != 0) if nonzero else fine


def matrices(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors as a matrix for each number of components, by ascending id."""
    if isinstance(ids, pa.ChunkedArray):
        ids, vectors = ids.combine_chunks(), vectors.combine_chunks()
    number = ids.to_numpy(zero_copy_only=False)
    ends = vectors.offsets.to_numpy()
    sizes, values = np.diff(ends), vectors.values.to_numpy(zero_copy_only=False)
    out = {}
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        at = at[np.argsort(number[at], kind="stable")]
        out[size] = number[at], values[ends[at][:, None] + np.arange(size)].astype(np.float64)
    return out


def best_lists(rows: DataFrame, query: str, order: list[Column], k: int, piece: str, pieces: int, fan: int = 32) -> DataFrame:
    """The first k rows of every query, merged up a tree: lists of ``fan`` neighbouring pieces at a time.

    Spark keeps k rows per list on both sides of each shuffle.
    """
    while pieces > fan:
        pieces = -(-pieces // fan)
        rows = rows.withColumn(piece, F.floor(F.col(piece) / fan))
        place = F.row_number().over(Window.partitionBy(query, piece).orderBy(*order))
        rows = rows.withColumn("rank", place).where(F.col("rank") <= k).drop("rank")
    place = F.row_number().over(Window.partitionBy(query).orderBy(*order))
    return rows.withColumn("rank", place.cast("int")).where(F.col("rank") <= k)


def first_of_rows(keys: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k smallest keys of every row of a matrix, ascending; keys of a row are distinct."""
    k = min(k, keys.shape[1])
    some = np.argpartition(keys, k - 1, axis=1)[:, :k] if k < keys.shape[1] else np.tile(np.arange(k), (len(keys), 1))
    order = np.argsort(np.take_along_axis(keys, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)
