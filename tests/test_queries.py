"""Every query with SQL gives the rows of that SQL on the smallest tables."""

import glob
import os

import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")

from tidemark.plans import ORACLE_SQL, QUERIES  # noqa: E402


def plain(v):
    if v is None or v is pd.NA or v != v:
        return "~"
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, float) and v == int(v):
        return str(int(v))
    return str(v)


def rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(x) for x in r) for r in df[names].itertuples(index=False))


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, sf_dir, con, name):
    assert rows(QUERIES[name](spark, sf_dir).toPandas()) == rows(con.sql(ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
