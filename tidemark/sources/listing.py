"""File listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import CHANGE_FILE_PATTERN, SNAPSHOT_FILE_PATTERN, parse_paths
from tidemark.sinks.scratch import materialize
from tidemark.sources.storage import file_statuses


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` with its modification time and size, empty ones included; listed in tasks."""
    return file_statuses(spark, root)


def take_listing(spark: SparkSession, root: str) -> DataFrame:
    """The parsed listing as a written table: one moment's files, read as often as needed."""
    return materialize(spark, parse_paths(list_files(spark, root)), "listing")


def matching(listing: DataFrame, pattern: str) -> DataFrame:
    """Rows whose whole path matches the pattern."""
    return listing.filter(F.col("full_file_path").rlike(f"^(?:{pattern})$"))


def snapshot_files(listing: DataFrame) -> DataFrame:
    return matching(listing, SNAPSHOT_FILE_PATTERN)


def change_files(listing: DataFrame) -> DataFrame:
    return matching(listing, CHANGE_FILE_PATTERN)
