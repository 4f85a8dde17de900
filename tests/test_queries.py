import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    clean = lambda v: "null" if v is None or v is pd.NA or v != v else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    return sorted(tuple(map(clean, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.core.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    assert rows(entry.queries()[name](spark, DATA).toPandas()) == rows(tables.sql(entry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "label", "start", "end", "text"]
