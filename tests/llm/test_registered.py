"""Registered queries against their SQL, and whole results of the others."""

import pytest

from __spark_entry__ import oracle_sql, queries
from checks.compare import compare, connect
from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    ok, note = compare(spark, connect(SF), SF, queries()[name], SQL[name])
    assert ok, note


@pytest.mark.parametrize("name, table", [("op1_token_counts", "documents"), ("op9_main_text", "pages"), ("op10_language", "documents")])
def test_a_row_for_each_row(spark, name, table):
    assert queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
