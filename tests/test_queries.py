"""Every query with SQL gives the SQL's rows; every other query gives rows."""

import duckdb
import pytest

import __spark_entry__ as contract
from backframe.plans.tables import TABLES
from tools.check import table

SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(SQL[name])
    want = table([d[0] for d in result.description], result.fetchall())
    got = table(df.columns, df.collect())
    assert got == want
    assert got[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 489
