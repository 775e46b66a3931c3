"""Parts of a landing-zone path as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import computed_once

# The path patterns of the landing zone.
CLIENT_PATTERN = r"/([^/]+)/Tables/"
TABLE_PATTERN = r"/Tables/([^/]+)/"
FOLDER_PATTERN = r"/(TableData_[^/]+)/"
ZONE_ANCHOR = "/LandingZone/"
SNAPSHOT_FILE_PATTERN = r".*FullCopyData.*[.]parquet"
CHANGE_FILE_PATTERN = r".*ChangeData.*[.]csv"
LISTING_TIME_FORMAT = "dd MMM yyyy HH:mm:ss z"


def first_group(path: Column, pattern: str) -> Column:
    """First capture of the first match, NULL where nothing matches."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def client_of(path: Column) -> Column:
    return first_group(path, CLIENT_PATTERN)


def table_of(path: Column) -> Column:
    """Table ids are compared without case everywhere, so they are lowered here, once."""
    return F.lower(first_group(path, TABLE_PATTERN))


def folder_of(path: Column) -> Column:
    return first_group(path, FOLDER_PATTERN)


def filename_of(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(-1))


def zone_relative(path: Column) -> Column:
    """The path from the landing zone on; the whole path where the anchor is absent."""
    return F.substr(path, F.locate(ZONE_ANCHOR, path))


def listing_time(text: Column) -> Column:
    """``Mon, 01 Jan 2024 10:00:00 GMT`` to a timestamp; the weekday is redundant."""
    return F.to_timestamp(F.substr(text, F.lit(6)), LISTING_TIME_FORMAT)


def file_read() -> Column:
    """The file a row was read from, spelt as listings spell it; the reader's own text is escaped as in a URL."""
    # In a path a plus is a plus; decoding alone would make it a space.
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def unschemed(path: Column) -> Column:
    """A local path as inventories and listings agree on it, without its scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def literal_path(path: Column) -> Column:
    """The path as a reader's argument, with the characters of patterns standing for themselves."""
    return F.regexp_replace(path, r"([\\{}\[\]*?])", r"\\$1")


PATH_PARTS = ("client_id", "table_id", "tabledata_folder", "filename", "relative_path")


def parse_paths(listing: DataFrame) -> DataFrame:
    """``full_file_path, last_modified`` and ``length`` if known, plus every part read from the path; a parsed listing stays as it is."""
    if set(PATH_PARTS) <= set(listing.columns):
        return listing
    path = F.col("full_file_path")
    modified = F.col("last_modified")
    if dict(listing.dtypes)["last_modified"] == "string":
        modified = listing_time(modified)
    return computed_once(
        listing.select(
            path,
            modified.alias("last_modified"),
            client_of(path).alias("client_id"),
            table_of(path).alias("table_id"),
            folder_of(path).alias("tabledata_folder"),
            filename_of(path).alias("filename"),
            zone_relative(path).alias("relative_path"),
            *(c for c in listing.columns if c == "length"),
        )
    )
