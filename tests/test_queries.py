"""Every registered query against its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import difference

QUERIES, SQL = queries(), oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, duckdb_con, name):
    assert difference(QUERIES[name](spark, sf_dir), duckdb_con, SQL[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
