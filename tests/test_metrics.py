"""Metrics (E1-E13) against hand-computed values of the small fixtures."""

import math

import pytest

from tabsmith.operators import evaluate as E

Y = [0, 1, 0, 1, 1, 0, 1, 0]
PERFECT_PRED = Y
PERFECT_P = [.1, .9, .2, .8, .7, .3, .9, .1]
IMPERFECT_PRED = [0, 1, 1, 1, 0, 0, 1, 0]
IMPERFECT_P = [.1, .9, .6, .8, .4, .3, .9, .2]


def frame(spark, y, pred, p):
    return spark.createDataFrame(list(zip(y, pred, p)), "y int, pred int, p double")


def test_perfect(spark):
    m = E.classification_metrics(frame(spark, Y, PERFECT_PRED, PERFECT_P), "y", "p", "pred").collect()[0]
    assert m["roc_auc"] == 1.0 and m["accuracy"] == 1.0 and m["f1"] == 1.0


def test_imperfect_values(spark):
    m = E.classification_metrics(frame(spark, Y, IMPERFECT_PRED, IMPERFECT_P), "y", "p", "pred").collect()[0]
    for k in ("roc_auc", "f1", "precision", "recall", "accuracy"):
        assert 0.0 <= m[k] <= 1.0
    assert m["accuracy"] == pytest.approx(0.75)
    assert m["precision"] == pytest.approx(0.75)
    assert m["recall"] == pytest.approx(0.75)
    assert m["f1"] == pytest.approx(0.75)
    assert m["roc_auc"] == pytest.approx(15 / 16)
    assert m["log_loss"] > 0


def test_log_loss_value(spark):
    m = E.log_loss(frame(spark, Y, IMPERFECT_PRED, IMPERFECT_P), "y", "p").collect()[0]["log_loss"]
    want = -sum(math.log(p) if y else math.log(1 - p) for y, p in zip(Y, IMPERFECT_P)) / len(Y)
    assert m == pytest.approx(want)


def test_regression_values(spark):
    df = spark.createDataFrame(list(zip([1., 2., 3., 4., 5.], [1.1, 1.9, 3.2, 3.8, 5.1])), "y double, pred double")
    m = E.regression_metrics(df, "y", "pred").collect()[0]
    assert set(m.asDict()) == {"rmse", "mae", "r2"}
    assert m["rmse"] == pytest.approx(math.sqrt(0.022))
    assert m["mae"] == pytest.approx(0.14)
    assert m["r2"] == pytest.approx(0.989)


def test_regression_perfect(spark):
    df = spark.createDataFrame([(float(v), float(v)) for v in range(1, 6)], "y double, pred double")
    m = E.regression_metrics(df, "y", "pred", with_mse=True).collect()[0]
    assert (m["rmse"], m["mae"], m["mse"], m["r2"]) == (0.0, 0.0, 0.0, 1.0)


def test_primary_metric():
    assert E.primary_metric_name("classification") == "roc_auc"
    assert E.primary_metric_name("regression") == "rmse"
    assert E.extract_primary_metric("classification", {"roc_auc": 0.8}) == ("roc_auc", 0.8)
    assert E.extract_primary_metric("regression", {}) == ("rmse", None)
    with pytest.raises(ValueError):
        E.primary_metric_name("ranking")


def test_one_class_auc_is_null(spark):
    df = frame(spark, [1, 1, 1], [1, 1, 1], [.2, .5, .9])
    assert E.roc_auc(df, "y", "p").collect()[0]["roc_auc"] is None


def test_tied_scores_auc_half(spark):
    df = frame(spark, [0, 1, 0, 1], [0, 0, 0, 0], [.5, .5, .5, .5])
    assert E.roc_auc(df, "y", "p").collect()[0]["roc_auc"] == 0.5


def test_auc_across_many_ranges(spark):
    """Exact AUC when the running sums are split over several ranges."""
    from tabsmith.operators import ranking
    rows = [(i % 3 == 0, (i * 7919 % 1000) / 1000.0) for i in range(3000)]
    df = spark.createDataFrame([(int(a), b) for a, b in rows], "y int, p double")
    old = ranking.ROWS_PER_RANGE
    try:
        ranking.ROWS_PER_RANGE = 50
        sc = E.score_counts(df, "y", "p")
        rs = ranking.running_sums(sc, "score", ["neg"], inclusive=False, rows_per_range=50)
        got = rs.agg({"neg": "sum"}).collect()[0][0]
        assert got == sum(1 for a, _ in rows if not a)
        auc = rs.selectExpr("sum(pos * (cum_neg + 0.5 * neg)) / (sum(pos) * sum(neg)) AS a").collect()[0]["a"]
    finally:
        ranking.ROWS_PER_RANGE = old
    pos = [p for a, p in rows if a]
    neg = [p for a, p in rows if not a]
    brute = sum((1.0 if x > z else 0.5 if x == z else 0.0) for x in pos for z in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute)


def test_threshold_curve_and_best(spark):
    df = frame(spark, Y, IMPERFECT_PRED, IMPERFECT_P)
    c = {r["i"]: r for r in E.threshold_curve(df, "y", "p", 11).collect()}
    assert len(c) == 11
    assert c[0]["recall"] == 1.0 and c[0]["precision"] == 0.5       # t = 0: all positive
    assert c[10]["recall"] == 0.0 and c[10]["precision"] == 0.0     # t = 1: none
    b = E.tune_threshold(df, "y", "p", "f1", 11).collect()[0]
    # brute force over the same thresholds, lowest threshold wins ties
    best = None
    for i in range(11):
        t = i * 0.1 if i < 10 else 1.0
        tp = sum(1 for y, p in zip(Y, IMPERFECT_P) if y and p >= t)
        fp = sum(1 for y, p in zip(Y, IMPERFECT_P) if not y and p >= t)
        fn = sum(1 for y, p in zip(Y, IMPERFECT_P) if y and p < t)
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        if best is None or f1 > best[1]:
            best = (t, f1)
    assert b["best_threshold"] == pytest.approx(best[0]) and b["best_score"] == pytest.approx(best[1])
    assert b["warning"] is True
    with pytest.raises(ValueError):
        E.tune_threshold(df, "y", "p", "balanced")


def test_multiclass_macro(spark):
    y = [0, 1, 2, 2, 1, 0]
    pred = [0, 2, 2, 2, 1, 1]
    df = spark.createDataFrame(list(zip(y, pred)), "y int, pred int")
    m = E.label_metrics(df, "y", "pred").collect()[0]
    # class 0: P 1, R .5; class 1: P .5, R .5; class 2: P 2/3, R 1
    assert m["precision"] == pytest.approx((1 + .5 + 2 / 3) / 3)
    assert m["recall"] == pytest.approx((.5 + .5 + 1) / 3)
