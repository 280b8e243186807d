"""Every query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from candlelake.plans.queries import ORACLES, QUERIES

from .conftest import SF


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if isinstance(x, (list, tuple)) or hasattr(x, "tolist") and hasattr(x, "__len__"):
            return str(list(x))
        if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
            return "null"
        return repr(round(float(x), 6)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)[:19]

    return sorted(tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
