import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import table_queries
from tidemark.functions import paths
from tidemark.functions.values import csv_field, list_items, lsn_number, scope_items, soft_cast
from tidemark.registry import table
from tidemark.session import configure


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def text(value):
    return F.lit(value).cast("string")


def rule(spark, value, sql):
    """The result of a rule's SQL text on one value, under the name v."""
    return spark.range(1).select((value if value is not None else text(None)).alias("v")).selectExpr(f"{sql} AS v").first().v


@pytest.mark.parametrize(
    ("given_text", "number"),
    [
        ("0x00009694000009E80002", 0x00009694000009E80002),
        ("0xFFFFFFFFFFFFFFFFFFFFFFFF", 2**96 - 1),
        ("zz10", 16),  # whatever the first two characters are
        ("0x" + "F" * 25, None),
        ("0xG1", None),
        ("0x", None),
        ("", None),
        (None, None),
    ],
)
def test_lsn_number(spark, given_text, number):
    got = one(spark, lsn_number(text(given_text)))
    assert (None if got is None else int(got)) == number


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2**96 - 1), min_size=1, max_size=40))
def test_lsn_numbers_keep_value_and_order(spark, numbers):
    rows = spark.createDataFrame([(f"0x{n:x}", str(n)) for n in numbers], "t string, n string")
    assert all(r.v == r.n for r in rows.select(lsn_number(F.col("t")).cast("string").alias("v"), "n").collect())


@pytest.mark.parametrize(
    ("word", "expected"),
    [("on", True), ("ON", True), ("off", False), ("1", True), ("y", True), ("F", False), ("No", False), ("maybe", None), ("", None)],
)
def test_boolean_words(spark, word, expected):
    assert rule(spark, F.lit(word), soft_cast("v", "string", "boolean")) is expected


@pytest.mark.parametrize(
    ("word", "kind", "expected"),
    [
        ("1.5", "decimal(38,0)", 2),
        ("1e3", "decimal(38,0)", 1000),
        ("", "decimal(38,0)", None),
        ("99999999999", "decimal(10,0)", None),
        ("2024-01-02 03:04:05.1234567", "timestamp_ntz", dt.datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ("soon", "timestamp_ntz", None),
    ],
)
def test_soft_casts(spark, word, kind, expected):
    assert rule(spark, F.lit(word), soft_cast("v", "string", kind)) == expected


def test_a_number_is_no_timestamp(spark):
    assert rule(spark, F.lit(20240101), soft_cast("v", "int", "timestamp_ntz")) is None
    assert rule(spark, F.lit(5), soft_cast("v", "int", "boolean")) is True


def test_csv_nulls(spark):
    assert rule(spark, None, csv_field("v")) == ""
    assert rule(spark, None, csv_field("v", "true")) is None
    assert rule(spark, text("null"), csv_field("v")) is None and rule(spark, text("NULL"), csv_field("v")) is None
    assert rule(spark, text("Null"), csv_field("v")) == "Null" and rule(spark, text(" NULL"), csv_field("v")) == " NULL"


def test_lists(spark):
    assert one(spark, list_items(text(" a, b ,,c"), upper=True)) == ["A", "B", "C"]
    assert scope_items(" a, b ,,") == ["a", "b"] and scope_items(",, ,") is None
    assert scope_items(None) is None and scope_items(["x"], upper=True) == ["X"]


def test_paths(spark):
    path = text("azure://box/LandingZone/acme/Tables/AB-1/TableData_02/FullCopyData/data-1.parquet")
    assert one(spark, paths.client_of(path)) == "acme" and one(spark, paths.table_of(path)) == "ab-1"
    assert one(spark, paths.folder_of(path)) == "TableData_02" and one(spark, paths.filename_of(path)) == "data-1.parquet"
    assert one(spark, paths.zone_relative(path)).startswith("/LandingZone/acme/")
    loose = text("somewhere/data.parquet")
    assert one(spark, paths.client_of(loose)) is None and one(spark, paths.zone_relative(loose)) == "somewhere/data.parquet"


def test_listing_time(spark):
    got = one(spark, paths.listing_time(text("Mon, 01 Jan 2024 10:00:00 GMT")).cast("timestamp_ntz"))
    assert got == dt.datetime(2024, 1, 1, 10)


def test_wide_rows_run_in_methods_the_jvm_compiles(spark):
    """HotSpot interprets methods above 8,000 bytes; a fused stage of 46 columns is far above it."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 65535)
    assert int(configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


@pytest.mark.parametrize("value", [True, False, None])
def test_hash_of_a_boolean_is_that_of_its_text(spark, value):
    spec = table("PAYTYPE")
    column = next(c for c in spec.file_columns if c.type == "boolean")
    row = spark.createDataFrame([(value,)], f"`{column.name}` boolean").select(F.expr(table_queries._print_of(spec, column))).first()
    assert row[0] == (None if value is None else int(hashlib.md5(str(value).lower().encode()).hexdigest()[:8], 16))
