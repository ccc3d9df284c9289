"""Every registered query next to its SQL twin."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tools.check import compare
from wordflow.plans.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).columns == ["word", "n"]


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, tables, name):
    assert compare(spark, tables, name, SF_DIR).startswith("ok")
