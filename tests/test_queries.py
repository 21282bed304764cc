"""Every query against its SQL on the smallest tables, and the rows of those without."""

import os

import duckdb
import pandas as pd
import pytest

from loomspark.plans import catalog
from loomspark.sources.tables import RAW

SF = os.environ.get("LOOMSPARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in RAW:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
        return "NULL"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    try:
        return f"{float(v):.9g}" if not isinstance(v, str) and not isinstance(v, pd.Timestamp) else str(v)
    except (TypeError, ValueError):
        return str(v)


def rows(df):
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, oracle, name):
    got = catalog.queries()[name](spark, SF).toPandas()
    if name in catalog.oracle_sql():
        expected = oracle.execute(catalog.oracle_sql()[name]).fetchdf()
        assert sorted(got.columns) == sorted(expected.columns)
        assert rows(got) == rows(expected)
    else:
        assert len(got) or name == "q7_cut_files"  # the smallest tables have too little speech to cut


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
