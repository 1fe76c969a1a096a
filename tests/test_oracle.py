"""Every registered query against its SQL on DuckDB, over the supplied tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from assayline.plans import oracle, registry
from tests.helpers import duck_rows, rows_of

QUERIES, ORACLE = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = con.execute(ORACLE[name])
    assert sorted(result.columns) == sorted(column[0] for column in expected.description)
    assert rows_of(result) == duck_rows(con, ORACLE[name])


def test_the_driver_sees_every_query():
    assert set(QUERIES) <= set(driver.queries())
    assert ORACLE.items() <= driver.oracle_sql().items()


def test_entry(spark):
    assert driver.entry(spark).count() > 0
