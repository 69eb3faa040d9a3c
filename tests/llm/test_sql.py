"""Queries with SQL match DuckDB on the smallest tables."""

import duckdb
import pytest

from tabsmith.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    rows = lambda df: sorted(map(repr, df[cols].astype(object).values.tolist()))
    assert rows(got) == rows(want)
