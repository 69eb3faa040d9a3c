"""Artefacts of training, tuning and threshold choice (S9); permutation importance in one pass (L4)."""

import json

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import evaluate as E
from tabsmith.operators import select as L
from tabsmith.operators import train as M
from tabsmith.operators import tune as H
from tabsmith.sources import artefacts

PREP = {"scaler": "standard", "hashing_dim": 4}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(90).select(F.col("id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11 / 3.0).alias("b"))
    return df.withColumn("y", 3.0 * F.col("a") - F.col("b") + (F.col("id") % 2)).persist()


def _scores(saved, df):
    pipe, model, feats = saved
    x = M.assemble(pipe.transform(df), feats, "y")
    return [r["prediction"] for r in M.score_frame(model, x, "regression").orderBy("id").collect()]


def test_training_comes_back(spark, rows, tmp_path):
    trainer = M.ModelTrainer().fit(rows, "y", key="id", prep_config=PREP, cv=3, models=["linear_regression", "lasso_regression"],
                                   param_overrides={"lasso_regression": {"alpha": 0.5}})
    artefacts.save_training(trainer, str(tmp_path / "t"))
    board, params, models = artefacts.load_models(spark, str(tmp_path / "t"))
    assert board.columns == M.LEADERBOARD_COLUMNS
    assert [r["model_name"] for r in board.collect()] == [r["model_name"] for r in trainer.leaderboard_.collect()] \
        == ["linear_regression", "lasso_regression"]
    assert params["lasso_regression"]["alpha"] == 0.5
    for name in models:
        assert _scores(models[name], rows) == pytest.approx(_scores(trainer.models_[name], rows), abs=1e-12)


def test_trials_come_back(spark, rows, tmp_path):
    trials, best, refit = H.random_search(rows, "y", "id", "lasso_regression", n_iter=3, cv=2, prep_config=PREP)
    artefacts.save_search(trials, {"lasso_regression": (best, refit)}, str(tmp_path / "s"))
    back, params, models = artefacts.load_models(spark, str(tmp_path / "s"))
    assert params == {"lasso_regression": best}
    found = back.orderBy("score").first()
    assert json.loads(found["params"]) == best                       # the best trial by rmse
    assert _scores(models["lasso_regression"], rows) == pytest.approx(_scores(refit, rows), abs=1e-12)
    # without a refit, and over what is there already
    artefacts.save_search(trials, {"lasso_regression": (best, None)}, str(tmp_path / "s"))
    assert artefacts.load_models(spark, str(tmp_path / "s"))[2] == {}


def test_threshold_comes_back(spark, tmp_path):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.6), (1, 0.9)], "y int, p double")
    artefacts.save_threshold(E.tune_threshold(df, "y", "p", "f1", 11), "m", str(tmp_path / "h"))
    got = artefacts.load_threshold(spark, str(tmp_path / "h")).first().asDict()
    assert got == {"model_name": "m", "optimal_threshold": pytest.approx(0.5), "metric": "f1", "best_score": 1.0}


def test_permutations_in_one_pass(spark, rows):
    seen = []

    def metric(long):
        got = long.groupBy("__variant").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("y").alias("y"),
                                            F.avg(F.abs(F.col("y") - 3 * F.col("a") + F.col("b"))).alias("e")).collect()
        seen.extend(got)
        return {r["__variant"]: -r["e"] for r in got}

    found = {r["feature"]: r["score"] for r in L.permutation_importance(rows, ["b", "a"], "id", metric).collect()}
    # a permutation moves values among rows: counts and sums stay
    assert {(r["n"], r["a"], round(r["b"], 6), r["y"]) for r in seen} == {(90, seen[0]["a"], round(seen[0]["b"], 6), seen[0]["y"])}
    assert {r["__variant"] for r in seen} == {0, 1, 2}
    assert found["a"] > found["b"] > 0
    assert L.permutation_importance(rows.limit(0), ["a"], "id", metric).collect() == []


def test_partitions_follow_the_values(rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int")).repartition(6)
    prepared = M.prepare_folds(folded, "y", "fold", 3, PREP, "regression", keep=("id",))
    try:
        assert all(p[0].rdd.getNumPartitions() == 1 and p[0].count() == 60 and p[1].count() == 30 for p in prepared.values())
    finally:
        M.release(prepared)
    whole, M.VALUES_A_PARTITION = M.VALUES_A_PARTITION, 30
    try:
        prepared = M.prepare_folds(folded, "y", "fold", 3, PREP, "regression", keep=("id",))
        # never more partitions than the rows came in
        assert all(1 < p[0].rdd.getNumPartitions() <= 6 and p[0].count() == 60 for p in prepared.values())
        M.release(prepared)
    finally:
        M.VALUES_A_PARTITION = whole
