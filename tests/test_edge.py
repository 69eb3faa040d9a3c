"""Quirk decisions on hand-made frames (D-EDGE): NULL keys, constants, NaN, ties."""

import pytest

from tabsmith.operators import assoc as A
from tabsmith.operators import engineer as G
from tabsmith.operators import profile as P


def test_group_aggregates_null_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 7.0)], "g string, x double")
    out = {r["x"]: r for r in G.add_group_aggregates(df, ["g"], ["x"]).collect()}
    assert out[1.0]["g_x_mean"] == 2.0
    assert out[5.0]["g_x_std"] == 0.0            # one row: sd 0
    assert out[7.0]["g_x_mean"] is None and out[7.0]["g_x_std"] == 0.0


def test_binning_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert {r["x_binned"] for r in G.add_bins(df, ["x"], 5).collect()} == {2.0}


def test_binning_matches_equal_width(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    got = [r["x_binned"] for r in G.add_bins(df, ["x"], 5).orderBy("x").collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_cramers_v_identical_and_independent(spark):
    rows = [(a, a, b) for a in "xyz" for b in "pq" for _ in range(10)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    v = {(r["feature_1"], r["feature_2"]): r["cramers_v"] for r in A.cramers_v_matrix(df, ["a", "b", "c"]).collect()}
    assert v[("a", "b")] == pytest.approx(1.0)
    assert v[("a", "c")] == pytest.approx(0.0, abs=1e-9)


def test_theils_u_constant(spark):
    # with +1e-9 inside log2, H of a constant is -1.44e-9 (not 0), so U is 0, not NULL
    df = spark.createDataFrame([("k", "x"), ("k", "y")], "a string, b string")
    u = {(r["feature_1"], r["feature_2"]): r["theils_u"] for r in A.theils_u_matrix(df, ["a", "b"]).collect()}
    assert u[("a", "b")] == pytest.approx(0.0, abs=1e-12)
    assert u[("b", "a")] == pytest.approx(0.0, abs=1e-6)


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert A.correlation_pairs(df, ["a", "b"]).collect()[0]["corr"] is None


def test_anova_single_group_is_null(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0)], "c string, x double")
    assert A.anova_f(df, ["x"], ["c"]).collect()[0]["f_stat"] is None


def test_spearman_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (2.0, 2.0), (3.0, 10.0)], "a double, b double")
    assert A.correlation_pairs(df, ["a", "b"], "spearman").collect()[0]["corr"] == pytest.approx(1.0)


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(31)], "x double")
    h = {r["bin"]: r["count"] for r in P.histogram(df, "x", 30).collect()}
    assert sum(h.values()) == 31 and h[30] == 2 and len(h) == 30


def test_box_stats_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "x double")
    b = P.box_stats(df, "x").collect()[0]
    assert b["median"] == 3.5 and b["n_outliers"] == 1 and b["whisker_high"] == 5.0


def test_wide_correlation_paths_agree(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(5)
    data = rng.standard_normal((200, 6))
    data[:, 1] = data[:, 0] * 0.5 + data[:, 1]
    cols = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in data], ", ".join(f"{c} double" for c in cols))
    narrow = {(r["feature_1"], r["feature_2"]): r["corr"] for r in A.correlation_pairs(df, cols).collect()}
    monkeypatch.setattr(A, "PAIRS_PER_PASS", 4)
    wide = {(r["feature_1"], r["feature_2"]): r["corr"] for r in A.correlation_pairs(df, cols).collect()}
    with_null = df.union(spark.createDataFrame([(None,) * 6], ", ".join(f"{c} double" for c in cols)))
    chunked = {(r["feature_1"], r["feature_2"]): r["corr"] for r in A.correlation_pairs(with_null, cols).collect()}
    for k, v in narrow.items():
        assert wide[k] == pytest.approx(v, abs=1e-12)
        assert chunked[k] == pytest.approx(v, abs=1e-12)
