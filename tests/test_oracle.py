"""Every catalog query with an oracle matches DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tabsmith.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    return cols, sorted(rows, key=key)


def test_every_query_is_registered():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 80


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "feature_type" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.sql(ORACLE[name]).df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
