"""Every registered query against its SQL on the driver's tables."""

import os

import pytest

import __spark_entry__ as entry
from plazalens.plans.oracle import ORACLE as SQL
from plazalens.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = os.path.splitext(file)[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = [tuple(row) for row in result.select(*columns).collect()]
    answer = duck.execute(SQL[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in answer.fetchall()]
    assert ordered(got) == ordered(expected)
    assert got


def test_entry_registers_all_queries():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["segment", "word", "count", "rank"]
    assert not result.isEmpty()
