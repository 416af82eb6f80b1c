"""Every registered query against its SQL."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from registry.oracles import ORACLES
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def database(tables):
    connection = duckdb.connect()
    for path in glob.glob(f"{tables}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()


def comparable(value):
    return round(value, 5) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, tables, name):
    frame = QUERIES[name](spark, tables)
    names = sorted(frame.columns)
    found = [tuple(comparable(row[n]) for n in names) for row in frame.collect()]
    sql = database.sql(ORACLES[name])
    assert sorted(sql.columns) == names
    places = [sql.columns.index(n) for n in names]
    expected = [tuple(comparable(row[p]) for p in places) for row in sql.fetchall()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert found


def test_entry(spark):
    assert entry_point.entry(spark).count() == 50
