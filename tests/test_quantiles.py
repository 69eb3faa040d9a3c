"""Exact quantiles by bracket selection against numpy, with brackets that miss and that overflow."""

import numpy as np
import pytest

from tabsmith.operators import quantiles as Q
from tabsmith.operators import ranking as RK

PROBS = [0.0, 0.03, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("accuracy,gather", [(20_000, 400_000), (20, 400_000), (20, 60), (7, 3), (200, 0)])
def test_quantiles_match_numpy(spark, monkeypatch, accuracy, gather):
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "GATHER", gather)
    rng = np.random.default_rng(accuracy + gather)
    n = 700
    data = {"a": np.round(rng.normal(size=n), 2), "b c": rng.integers(0, 7, n).astype(float),
            "h": np.where(rng.random(n) < 0.4, 5.0, rng.normal(size=n)), "one": np.full(n, 2.5), "neg": -rng.exponential(size=n)}
    rows = [tuple(float(v[i]) for v in data.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in data)).repartition(4)
    got = Q.quantile_arrays(df, list(data), PROBS)
    for c, v in data.items():
        assert got[c] == pytest.approx(list(np.quantile(v, PROBS)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("gather", [400_000, 1])
def test_odd_columns(spark, monkeypatch, gather):
    monkeypatch.setattr(Q, "GATHER", gather)
    inf, nan = float("inf"), float("nan")
    rows = [(None, 1, inf, nan), (None, 2, inf, 1.0), (None, 2, -inf, None), (None, 9, 0.0, nan), (None, None, inf, 3.0)]
    df = spark.createDataFrame(rows, "e double, i int, x double, z double")
    got = Q.quantile_arrays(df, ["e", "i", "x", "z"], [0.0, 0.25, 0.5, 1.0])
    assert got == {"e": [None] * 4, "i": [1.0, 1.75, 2.0, 9.0], "x": [-inf, 0.0, inf, inf], "z": [1.0, 1.5, 2.0, 3.0]}
    assert Q.quantile_arrays(df.limit(0), ["i"], [0.5]) == {"i": [None]}
    assert Q.quantile_arrays(df, [], [0.5]) == {}


def test_no_exchange_of_values(spark):
    """What the counting scan exchanges is cells and values inside brackets."""
    df = spark.range(200_000).selectExpr("CAST(id * 7919 % 199999 AS DOUBLE) AS q0")
    c = Q._Column(200_000, 0, [0.5])
    c.add([99_000.0, 101_000.0])
    counts = Q._counts(df, [c], {0: c.open_between(99_000.0, 101_000.0)}, False)
    assert len(counts) == 5 and sum(len(v) for v in counts.values()) < 2_100
    assert sum(sum(v.values()) for v in counts.values()) == 200_000


@pytest.mark.parametrize("per_range", [10 ** 9, 37])
def test_grouped_quantiles(spark, monkeypatch, per_range):
    orig = RK.running_sums
    monkeypatch.setattr(RK, "running_sums", lambda *a, **k: orig(*a, **{"rows_per_range": per_range, **k}))
    rng = np.random.default_rng(3)
    a, g = np.round(rng.normal(size=500), 2), np.minimum(rng.integers(0, 6, 500), 2)
    df = spark.createDataFrame([(float(x), int(y)) for x, y in zip(a, g)] + [(None, 1), (4.0, None), (float("nan"), 0)], "a double, g int")
    got = {r["g"]: r for r in RK.grouped_quantiles(df, "a", PROBS, "g").collect()}
    assert set(got) == {0, 1, 2}
    for grp, r in got.items():
        assert r["n"] == (g == grp).sum()
        assert list(r["q"]) == pytest.approx(list(np.quantile(a[g == grp], PROBS)), rel=1e-12, abs=1e-12)


def test_groups_as_columns_equal_groups_by_rows(spark, monkeypatch):
    from tabsmith.operators import profile as P
    rows = [("a" if i % 3 else "b", i % 2 == 0, float(i * 7 % 41) if i % 5 else None) for i in range(200)] + [
        (None, True, 1.0), ("a", None, 2.0), ("c", True, float("nan")), ("d", True, 5.0), ("a", True, float("inf"))]
    df = spark.createDataFrame(rows, "g string, `h h` boolean, x double").repartition(4)
    found = {}
    for groups, known in ((32, 10_000), (0, 10_000), (0, 0)):
        monkeypatch.setattr(RK, "GROUPS_AS_COLUMNS", groups)
        monkeypatch.setattr(P, "BROADCAST_GROUPS", known)
        found[groups, known] = sorted(map(tuple, P.box_stats(df, "x", by=["g", "h h"]).collect()))
        few = RK.grouped_quantiles(df, "x", PROBS, ["g", "h h"])
        if groups:      # no shuffle of the values
            assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
            plan = P.box_stats(df, "x", by=["g", "h h"])._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert found[32, 10_000] == found[0, 10_000] == found[0, 0] and len(found[0, 0]) == 5
