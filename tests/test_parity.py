"""Every registered query against its SQL counterpart, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, rows_of
from orderlake import oracle, registry

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db(spark):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"/root/testdata/sf0.001/{name}.parquet"
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def test_every_query_has_a_counterpart():
    assert set(registry.QUERIES) == set(oracle.REPORTS)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = rows_of(columns, result.fetchall())
    assert rows_of(df.columns, df.collect()) == expected
    assert expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
