"""The newest change per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Change types of the change files; 3 is the image before an update.
DELETE, INSERT, BEFORE_IMAGE, UPDATE = 1, 2, 3, 4
DEFAULT_ORDER = ("lsn", "seq", "_file", "_row")


def effective(changes: DataFrame) -> DataFrame:
    """Changes that do something. Filtering comes before ranking, so a before-image never hides a change."""
    return changes.filter(F.col("change_type").isin(DELETE, INSERT, UPDATE))


def newest_first(order) -> list[Column]:
    return [F.desc_nulls_last(c) if isinstance(c, str) else c for c in order]


def latest_changes(changes: DataFrame, keys: list[str], order=DEFAULT_ORDER) -> DataFrame:
    """One change per key: the one with the greatest ``order``, NULLs last.

    ``row_number() = 1`` plans as a group limit on both sides of the shuffle:
    each task sends at most one row per key, so a key with a third of all
    changes does not become one big task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first(order)))
    return effective(changes).withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
