"""Every registered query against its SQL on the smallest tables: rows, column names and types."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from monthmill.given.queries import QUERIES
from tests.compare import connect, kinds, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) & set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["zone", "trips"]
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    text = oracle_sql()[name]
    assert spark_rows(df) == sql_rows(con, text)
    ours, theirs = kinds(con, text, df)
    assert ours == theirs
