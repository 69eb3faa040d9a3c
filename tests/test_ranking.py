"""Distributed ranks against brute force, including the multi-range path."""

import pytest

from tabsmith.operators import ranking as RK


@pytest.fixture(params=[10 ** 9, 37], ids=["one-range", "many-ranges"])
def rows_per_range(request, monkeypatch):
    monkeypatch.setattr(RK, "ROWS_PER_RANGE", request.param)
    # running_sums reads the default at call time through the module attribute
    orig = RK.running_sums

    def patched(*a, **k):
        k.setdefault("rows_per_range", request.param)
        return orig(*a, **k)
    monkeypatch.setattr(RK, "running_sums", patched)
    return request.param


def test_no_window_runs_in_a_single_task(spark):
    from tabsmith.operators import evaluate as E
    from tabsmith.operators import split as X
    df = spark.range(2000).selectExpr("id", "id % 2 AS y", "(id * 7919 % 1999) / 1999 AS p")
    for out in (E.roc_auc(df, "y", "p"), E.roc_points(df, "y", "p"), X.kfold(df, "id", 5)):
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(lines):
            if "Window " in line:
                below = next(x for x in lines[i + 1:] if "Exchange" in x)
                assert "SinglePartition" not in below


def test_average_ranks(spark, rows_per_range):
    vals = [3.0, 1.0, 2.0, 2.0, 5.0, 5.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["value"]: r["rank"] for r in RK.average_ranks(df, "x").collect()}
    assert got == {1.0: 1.0, 2.0: 2.5, 3.0: 4.0, 5.0: 6.0}


def test_counts_below_with_duplicate_edges(spark):
    from pyspark.sql import functions as F

    from tabsmith.functions.exprs import with_counts_below
    edges = [1.0, 2.0, 2.0, 2.0, 5.0]
    vals = [None, 0.5, 1.0, 1.5, 2.0, 2.5, 5.0, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["b"] for r in with_counts_below(df, {"b": (F.col("x"), edges)}).collect()]
    want = [None if v is None else sum(1 for e in edges if e < v) for v in vals]
    assert got == want
