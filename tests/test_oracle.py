"""Every query with a SQL counterpart gives the same rows."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect


@pytest.fixture(scope="module")
def con(folder):
    connection: duckdb.DuckDBPyConnection = connect(folder)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, con, folder, name):
    rows = queries()[name](spark, folder).toPandas()
    assert compare(rows, con.execute(oracle_sql()[name]).df()) == ""


def test_entry(spark, folder):
    row = entry(spark).first()
    assert 0 < row["mean_ndcg"] < 1 and row["groups"] > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
