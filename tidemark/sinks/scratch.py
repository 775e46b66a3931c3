"""Intermediate tables in the shared scratch folder.

Written out rather than cached: they survive lost executors, cut the lineage,
and give the planner real sizes to choose join strategies by.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path


#: The codec for tables as large as the input, which weigh more on disk than on the CPU.
SMALL = "zstd"


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that this thread writes within are removed at the end: the batches of a stream would fill the folder with them."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def materialize(spark: SparkSession, rows: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    path = scratch_path(spark, label)
    if (paths := _passing.get()) is not None:
        paths.append(path)
    (rows.write.option("compression", compression) if compression else rows.write).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
