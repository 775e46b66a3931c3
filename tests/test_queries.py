"""Every registered query against its SQL on the smallest given tables."""

import os
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


#: Queries of the text operators have tests of their own.
OWN = [name for name in queries() if not re.match(r"op\d+_|pipeline$", name)]


def test_every_query_has_sql():
    assert set(OWN) == {name for name in oracle_sql() if name in OWN}


def test_entry(spark):
    assert entry(spark).columns == ["id", "amount", "note"] and entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query(spark, name):
    ok, note = compare(spark, connect(DATA), DATA, queries()[name], oracle_sql()[name])
    assert ok, note
