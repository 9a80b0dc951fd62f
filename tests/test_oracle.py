"""Every registered query against its SQL on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from footfall.plans.catalog import ORACLES, RUNS
from conftest import bag

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(RUNS) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    result = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = bag([dict(zip(columns, row)) for row in result.fetchall()], sorted(columns))
    assert bag(df.collect(), sorted(columns)) == want
