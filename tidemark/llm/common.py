"""Helpers shared by the operators: folds, byte batches, packed rows."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; rows without an id are in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds, F.lit(0))


def slices(batch: pa.RecordBatch, column: str, limit: int, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch of about ``limit`` bytes of text and at most ``rows`` rows; a longer text is a part of its own."""
    start = size = 0
    for i, n in enumerate(lengths(batch.column(column)).tolist()):
        if i > start and (size + n > limit or i - start == rows):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def lengths(values: pa.Array) -> np.ndarray:
    """Bytes of each value; null counts as none."""
    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def as_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a column one after another, and the ends of its rows."""
    ends = np.cumsum(lengths(values))
    data = b"".join(x.encode() if isinstance(x, str) else x for x in values.to_pylist() if x is not None)
    return np.frombuffer(data, np.uint8), ends


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, row) of every word ``[^\\x20\\x09-\\x0D]+``; words end where a row ends."""
    gap = SPACE[data]
    first = ~gap
    first[1:] &= gap[:-1]
    last = ~gap
    last[:-1] &= gap[1:]
    if len(data):
        inner = ends[(ends > 0) & (ends < len(data))]
        first[inner] = ~gap[inner]
        last[inner - 1] = ~gap[inner - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, stop, np.searchsorted(ends, start, side="right")


_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, extended as longer inputs come."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (self._powers(x, n) for x in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    def clear(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return out.cumprod(dtype=np.uint64)


_POWERS = Powers()


def hash_slices(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:stop] for every pair, wherever the slice stands."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def _release() -> None:
    """Gives memory that is free in this process back to the system; a worker waits for its next task with little."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def lean(run: Callable, *caches) -> Callable:
    """A function for Arrow batches, or for one or two Arrow tables, that empties the caches and frees memory when it is done.

    Workers outlive their tasks, and a task of another stage, or the JVM beside
    them, needs what they would keep. ``caches`` are functions that empty one.
    """

    def done() -> None:
        for clear in caches:
            clear()
        _release()

    if inspect.isgeneratorfunction(run):

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from run(batches)
            finally:
                done()

        return task

    if len(inspect.signature(run).parameters) == 1:

        def group(table: pa.Table) -> pa.Table:
            try:
                return run(table)
            finally:
                done()

        return group

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            done()

    return pair


def parts_for(size: float, per_part: float, least: int = 1) -> int:
    """Number of parts of about ``per_part`` that hold ``size``."""
    return max(least, int(-(-size // per_part)))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables of whole groups of equal integer keys, with the groups' starts and the end.

    Holds ``rows`` rows or one group, whichever is more.
    """

    def starts(table: pa.Table) -> np.ndarray:
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for key in keys:
            values = table.column(key).to_numpy()
            change |= values[1:] != values[:-1]
        return np.concatenate(([0], np.flatnonzero(change) + 1))

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            cuts = starts(table)
            if len(cuts) > 1:
                yield table.slice(0, cuts[-1]), cuts
                held, size = table.slice(cuts[-1]).to_batches(), table.num_rows - int(cuts[-1])
    if size:
        table = pa.Table.from_batches(held)
        yield table, np.append(starts(table), table.num_rows)


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
