"""Preprocessing pipeline invariants (F1-F23) on the synthetic pipeline frame."""

import math

import numpy as np
import pandas as pd
import pytest

from tabsmith.operators.prep import FeaturePipeline, NotFittedError

CONFIG = {"scaler": "standard", "hashing_dim": 8,
          "feature_selection": {"variance_threshold": 0.0, "correlation_threshold": None, "protected_features": []}}


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(42)
    n = 200
    num1 = rng.standard_normal(n)
    num1[rng.choice(n, 20, replace=False)] = np.nan
    cat = rng.choice(["a", "b", "c"], n).astype(object)
    cat[rng.choice(n, 10, replace=False)] = None
    pdf = pd.DataFrame({
        "numeric_1": num1,
        "numeric_2": 10 * rng.standard_normal(n) + 5,
        "binary_col": rng.integers(0, 2, n).astype("int64"),
        "cat_col": cat,
        "high_card": [f"id_{i % 60}" for i in range(n)],
    })
    df = spark.createDataFrame(pdf)
    from tabsmith.functions.exprs import normalize_nans
    return normalize_nans(df)


@pytest.fixture(scope="module")
def fitted(frame):
    return FeaturePipeline(CONFIG).fit(frame)


@pytest.fixture(scope="module")
def out(fitted, frame):
    return fitted.transform(frame).toPandas()


def test_types(fitted):
    ft = fitted.state["feature_types"]
    assert ft["numeric"] == ["numeric_1", "numeric_2"]
    assert ft["binary"] == ["binary_col"]
    assert ft["categorical"] == ["cat_col"]
    assert ft["high_cardinality"] == ["high_card"]


def test_no_nulls(out):
    assert not out.isnull().any().any()


def test_no_infinity(out):
    assert not np.isinf(out.to_numpy(dtype=float)).any()


def test_all_numeric(out):
    assert all(np.issubdtype(t, np.number) for t in out.dtypes)


def test_output_columns(out):
    cols = list(out.columns)
    assert cols[:3] == ["numeric_1", "numeric_2", "binary_col"]
    assert [c for c in cols if c.startswith("cat_col__")] == ["cat_col__a", "cat_col__b", "cat_col__c"]
    assert [c for c in cols if c.startswith("high_card__hash_")] == [f"high_card__hash_{j}" for j in range(8)]


def test_error_before_fit(frame):
    with pytest.raises(NotFittedError):
        FeaturePipeline(CONFIG).transform(frame)


def test_fit_transform_equals_fit_then_transform(frame, out):
    again = FeaturePipeline(CONFIG).fit_transform(frame).toPandas()
    pd.testing.assert_frame_equal(again, out)


def test_standard_scaling_is_zero_mean(out):
    assert abs(out["numeric_2"].mean()) < 1e-9


def test_imputation_median(fitted, frame):
    med = frame.toPandas()["numeric_1"].median()
    assert fitted.state["imputers"]["numeric_1"] == ["median", pytest.approx(med)]


def test_mode_lowest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "c string")
    p = FeaturePipeline({}).fit(df)
    assert p.state["imputers"]["c"] == ["mode", "a"]


def test_hash_bucket_matches_md5(fitted, frame):
    import hashlib
    pdf = frame.toPandas()
    out = fitted.transform(frame).toPandas()
    for i in range(10):
        b = int(hashlib.md5(str(pdf["high_card"][i]).encode()).hexdigest(), 16) % 8
        assert out[f"high_card__hash_{b}"][i] == 1.0
        assert out[[f"high_card__hash_{j}" for j in range(8)]].iloc[i].sum() == 1.0


@pytest.mark.parametrize("scaler", ["standard", "minmax", "robust"])
def test_each_scaler(frame, scaler):
    res = FeaturePipeline({"scaler": scaler, "hashing_dim": 8}).fit_transform(frame).toPandas()
    assert not res.isnull().any().any()
    if scaler == "minmax":
        assert res["numeric_2"].min() == pytest.approx(0.0) and res["numeric_2"].max() == pytest.approx(1.0)
    if scaler == "robust":
        assert res["numeric_2"].median() == pytest.approx(0.0, abs=1e-9)


def test_selection_variance_and_correlation(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal(100)
    pdf = pd.DataFrame({"a": a, "b": a * 2 + 1e-3 * rng.standard_normal(100), "c": rng.standard_normal(100),
                        "k": np.zeros(100)})
    df = spark.createDataFrame(pdf)
    p = FeaturePipeline({"feature_selection": {"variance_threshold": 1e-6, "correlation_threshold": 0.9}}).fit(df)
    assert p.state["selected_features"] == ["a", "c"]
    p2 = FeaturePipeline({"feature_selection": {"correlation_threshold": 0.9, "protected_features": ["b"]}}).fit(df)
    assert "b" in p2.state["selected_features"] and "a" not in p2.state["selected_features"]


def test_datetime_parts_and_missing(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 6, 10, 30, 15),), (dt.datetime(2024, 1, 8, 0, 0, 0),), (None,)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    res = FeaturePipeline({}).fit_transform(df).toPandas()
    assert list(res["t__dayofweek"]) == [5, 0, -1]          # Saturday=5, Monday=0, missing → -1
    assert list(res["t__is_weekend"]) == [1, 0, 0]
    assert list(res["t__days_since"]) == [0, 1, -1]         # floored whole days
    assert list(res["t__missing"]) == [0, 0, 1]


def test_unseen_category_all_zero_and_extra_column(spark):
    train = spark.createDataFrame([("a" if i % 2 else "b", float(i)) for i in range(30)], "c string, x double")
    test = spark.createDataFrame([("z", 1.0)], "c string, x double")
    p = FeaturePipeline({"feature_selection": {"selected_features": ["x", "c__a", "c__b"]}}).fit(train)
    res = p.transform(test).toPandas()
    assert list(res.columns) == ["x", "c__a", "c__b"]
    assert res["c__a"][0] == 0 and res["c__b"][0] == 0


def test_persistence_roundtrip(spark, fitted, frame):
    text = fitted.to_json()
    again = FeaturePipeline.from_json(text)
    a = fitted.transform(frame).toPandas()
    b = again.transform(frame).toPandas()
    pd.testing.assert_frame_equal(a, b)
    assert math.isfinite(float(a["numeric_2"].sum()))


def test_distributed_quantiles_equal_map_quantiles(frame, monkeypatch):
    import tabsmith.operators.prep as prep
    a = FeaturePipeline({"scaler": "robust"}).fit(frame).state
    monkeypatch.setattr(prep, "EXACT_MAP_MAX_DISTINCT", 0)
    b = FeaturePipeline({"scaler": "robust"}).fit(frame).state
    for c in ("numeric_1", "numeric_2"):
        assert a["imputers"][c][1] == pytest.approx(b["imputers"][c][1], rel=1e-12)
        assert a["scalers"][c][1:] == pytest.approx(b["scalers"][c][1:], rel=1e-12)
