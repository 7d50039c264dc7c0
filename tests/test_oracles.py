"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
import workload

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in workload.GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(entry.core_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.core_queries()))
def test_query(spark, duck, name):
    df = entry.core_queries()[name](spark, SF)
    found = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(row)) for row in df.select(*names).collect()) == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 8
