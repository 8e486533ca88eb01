"""Every query with a SQL twin, compared at the smallest scale."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(frame: pd.DataFrame):
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return "~"
        if isinstance(v, bool):
            return str(v)
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, (int, float)) or (hasattr(v, "dtype") and v.dtype.kind in "iuf"):
            return f"{float(v):.6f}"
        return str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(text(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours = entry.queries()[name](spark, FOLDER).toPandas()
    theirs = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
