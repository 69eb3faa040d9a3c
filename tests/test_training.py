"""Training, tuning and attribution on small frames whose answers are known."""

import random

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import select as L
from tabsmith.operators import split as X
from tabsmith.operators import train as M
from tabsmith.operators import tune as H

PREP = {"scaler": "standard", "hashing_dim": 8}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(240):
        k = i % 3
        data.append((i, rng.gauss(3.0 * k, 0.7), rng.gauss(0, 1), "xyz"[rng.randrange(3)], "abc"[k], k + 1 if k < 2 else 1))
    return spark.createDataFrame(data, "id long, u double, v double, c string, kind string, half int").persist()


def test_text_targets_with_three_classes(rows):
    df = rows.drop("half")
    assert M.infer_task(df, "kind") == "classification" and M.class_list(df, "kind") == ["a", "b", "c"]
    tr = M.ModelTrainer().fit(df, "kind", "id", PREP, cv=3, models=["logistic_regression", "gbt_classifier"],
                              param_overrides={"logistic_regression": {"maxIter": 50}}, refit=False)
    best = {r["model_name"]: r for r in tr.leaderboard_.collect()}
    assert set(best) == {"logistic_regression", "gbt_classifier"}       # the forest stands in for boosting
    assert all(r["accuracy"] > 0.9 and r["roc_auc"] > 0.95 and 0 < r["log_loss"] < 0.7 for r in best.values())


def test_classes_need_not_start_at_zero(rows):
    df = rows.select("id", "u", "v", (F.col("u") > 3).cast("int").alias("y"))
    df = df.withColumn("y", F.col("y") + 1)
    out = M.out_of_fold(df, "y", "id", "logistic_regression", {"maxIter": 50}, cv=4, prep_config=PREP)
    assert out.count() == 240 == out.select("id").distinct().count()
    assert {r["label"] for r in out.select("label").distinct().collect()} == {0.0, 1.0}
    right = out.join(df, "id").where(F.col("prediction") + 1 == F.col("y")).count()
    assert right > 220 and out.select("fold").distinct().count() == 4


def test_early_stopping_grows_fewer_trees(rows):
    df = rows.select((F.rand(3) > 0.5).cast("int").alias("y"), "u", "v")
    train, valid = df.where("u < 4"), df.where("u >= 4")
    frames = [M.assemble(p, ["u", "v"], "y", [0, 1]).select("label", M.FEATURES_COL) for p in (train, valid)]
    params = {**M.resolve("gbt_classifier")[0].defaults, "maxIter": 25, "maxDepth": 3}
    n = train.count()
    whole = M.fit_estimator(*frames, "gbt_classifier", params, n, 0.5, 2)
    early = M.fit_estimator(*frames, "gbt_classifier", {**params, "early_stopping": True}, n, 0.5, 2)
    assert early.getNumTrees < whole.getNumTrees == 25


def test_bad_overrides_and_models():
    with pytest.raises(ValueError, match="nonsense"):
        M.validate_param_overrides("ridge_regression", {"nonsense": 1})
    with pytest.raises(KeyError):
        M.resolve("nothing")


def test_search_finds_the_better_trial(rows):
    df = rows.select("id", "u", "v", "half")
    trials, best, refit = H.random_search(df, "half", "id", "logistic_regression", n_iter=3, cv=3, prep_config=PREP,
                                          scoring="neg_log_loss")
    scores = [r["score"] for r in trials.orderBy("trial").collect()]
    draws = H.param_maps("logistic_regression", 3)
    assert best["C"] == draws[scores.index(min(scores))]["C"] and refit is not None
    with pytest.raises(ValueError):
        H.run_tuning(df, "half", "id", "logistic_regression", {"tuning": {"method": "grid"}})


def test_refit_after_selection(rows):
    df = rows.select("u", "v", "half")
    _, _, feats = M.fit_full(df, "half", "logistic_regression", {"maxIter": 20}, PREP, selected=["u"])
    assert feats == ["u"]


def test_importances(spark, rows):
    df = rows.select("u", "v", "half")
    _, model, feats = M.fit_full(df, "half", "random_forest_classifier", {"numTrees": 20, "maxDepth": 4}, PREP)
    imp = L.tree_importances(spark, model, feats).collect()
    assert abs(sum(r["score"] for r in imp) - 1) < 1e-9


def test_regression_ranks_by_error(rows):
    df = rows.select("id", "v", "c", (F.col("u") * 2).alias("y"), "u")
    tr = M.ModelTrainer().fit(df, "y", "id", PREP, cv=3, models=["linear_regression", "lasso_regression"])
    board = tr.leaderboard_.collect()
    assert [r["model_name"] for r in board] == ["linear_regression", "lasso_regression"] and board[0]["rmse"] < 1e-6
    assert set(tr.models_) == {"linear_regression", "lasso_regression"} and tr.best().count() == 1


def test_domain_hook_and_categorical_positions(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "n int, s string, x double")
    assert X.add_domain_features(df, lambda d: d.withColumn("z", F.col("x") * 2)).first()["z"] == 4.0
    assert X.categorical_positions(df) == [1]


def test_no_partition_of_a_fit_grows_with_the_table(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tabsmith.operators import train as M
    df = spark.range(0, 400, 1, 2).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 37).cast("double").alias("x"))
    assert M.spread(df, 800) is df
    monkeypatch.setattr(M, "FIT_VALUES", 100)
    seen = []
    fit = M.fit_estimator
    monkeypatch.setattr(M, "fit_estimator", lambda train, *a: seen.append(train.rdd.getNumPartitions()) or fit(train, *a))
    M.fit_full(df, "y", "random_forest_classifier", {"numTrees": 2, "maxDepth": 2})
    assert seen[0] >= 4 and M.spread(df, 100) is df
