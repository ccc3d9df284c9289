"""The queries of the subpackage that have SQL, next to it."""

import glob
import os

import duckdb
import pytest

from tools.check import compare
from wordflow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows_as_sql(spark, tables, name):
    assert compare(spark, tables, name, SF_DIR).startswith("ok")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n not in ("op2_decontamination", "op8_token_counts")])
def test_a_row_per_document(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in documents.collect())
