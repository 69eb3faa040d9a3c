"""The preprocessing as Spark ML stages, sparse vectors, trials in one frame, patience, dates, hot groups."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tabsmith.operators import engineer as G
from tabsmith.operators import evaluate as E
from tabsmith.operators import stages as ST
from tabsmith.operators import train as M
from tabsmith.operators.prep import FeaturePipeline, NotFittedError
from tabsmith.sources import io as S

CONFIG = {"scaler": "standard", "hashing_dim": 7, "low_cardinality_threshold": 5}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(i, rng.gauss(0, 1) if i % 9 else None, "abc"[rng.randrange(3)] if i % 7 else None, f"n{rng.randrange(40)}", i % 3, i % 2,
             i // 2 % 4) for i in range(200)]      # both classes in every fold
    return spark.createDataFrame(data, "id long, u double, `c.x` string, name string, k int, y int, fold int").persist()


def test_vector_equals_the_columns(rows):
    pipe = FeaturePipeline(CONFIG).fit(rows.drop("id", "fold"), "y")
    out = ST.encoded(pipe, rows, "x", ["id", "y"])
    names = ST.position_names(ST.vector_parts(out, "x"))
    assert sorted(names) == sorted(pipe.feature_names())
    wide = {r["id"]: r for r in pipe.transform(rows).collect()}
    for r in out.select("id", vector_to_array("x").alias("v")).collect():
        assert list(r["v"]) == pytest.approx([float(wide[r["id"]][n]) for n in names])


def test_unseen_levels_have_no_entry(spark, rows):
    model = ST.TabularFeatures(config=CONFIG, target="y", ignored=["id", "fold"]).fit(rows)
    other = rows.limit(1).withColumn("`c.x`", F.lit("zzz")).select("id", "u", F.lit("zzz").alias("c.x"), "name", "k", "y", "fold")
    out = model.transform(other)
    part = next(p for p in ST.vector_parts(out, "features") if p["column"] == "c.x")
    v = out.select(vector_to_array("features").alias("v")).first()["v"]
    assert sum(v[part["from"]:part["from"] + part["size"]]) == 0


def test_selected_features(rows):
    config = {**CONFIG, "feature_selection": {"selected_features": ["u", "name__hash_3"]}}
    pipe = FeaturePipeline(config).fit(rows.drop("id", "fold"), "y")
    out = ST.encoded(pipe, rows, "x")
    assert ST.position_names(ST.vector_parts(out, "x")) == ["u", "name__hash_3"]


def test_pipeline_in_cross_validator_and_after_reload(spark, rows, tmp_path):
    steps = Pipeline(stages=[ST.TabularFeatures(config=CONFIG, target="y", ignored=["id", "fold"], outputCol="x"),
                             LogisticRegression(featuresCol="x", labelCol="y", maxIter=5)])
    grid = ParamGridBuilder().addGrid(steps.getStages()[1].regParam, [0.5]).build()
    best = CrossValidator(estimator=steps, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol="y"),
                          numFolds=2, foldCol="fold").fit(rows.withColumn("fold", F.col("fold") % 2)).bestModel
    best.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    score = lambda m: [(r["id"], list(r["probability"])) for r in m.transform(rows).orderBy("id").collect()]
    assert score(best) == score(again)
    assert ST.TabularFeatures(config=CONFIG, target="y").copy().getOrDefault("target") == "y"


def test_hundred_thousand_buckets_train_a_model(rows):
    feats = ST.TabularFeatures(config={"hashing_dim": 100_000, "low_cardinality_threshold": 5}, target="y", ignored=["id", "fold", "u", "c.x", "k"],
                               outputCol="x")
    out = feats.fit(rows).transform(rows)
    assert out.columns == [*rows.columns, "x"] and out.first()["x"].size == 100_000 and out.first()["x"].numNonzeros() == 1
    assert LogisticRegression(featuresCol="x", labelCol="y", maxIter=2).fit(out).numFeatures == 100_000


def test_unfitted_is_an_error(rows):
    with pytest.raises(NotFittedError):
        FeaturePipeline().coded(rows)


@pytest.mark.parametrize("classes", [2, 3])
def test_trials_and_folds_are_measured_as_one_by_one(rows, classes):
    df = rows.select("u", "name", (F.col("id") % classes).cast("int").alias("y"), "fold").na.fill(0.0)
    prepared = M.prepare_folds(df, "y", "fold", 2, CONFIG, "classification")
    trials = [{"maxIter": 3, "C": c} for c in (0.1, 1.0)]
    models = {k: m for k, (m, _) in M.fit_trials(prepared, "logistic_regression", trials).items()}
    found = M.measured(models, prepared, "classification")
    assert set(found) == {(t, i) for t in (0, 1) for i in (0, 1)}
    for (t, i), got in found.items():
        one = M.score_frame(models[t, i], prepared[i][1], "classification")
        want = E.label_metrics(one, "label", "prediction").first().asDict()
        want["roc_auc"] = (E.roc_auc(one, "label", "p1") if classes == 2 else E.roc_auc_ovr(one, "label", "probability")).first()[0]
        for k, v in want.items():
            assert got[k] == pytest.approx(v), (t, i, k)
        assert 0 < got["log_loss"] < 3
    M.release(prepared)


def test_regression_trials(rows):
    df = rows.select("u", "k", (F.col("u") * 2 + F.col("k")).alias("y"), "fold").na.drop()
    prepared = M.prepare_folds(df, "y", "fold", 2, CONFIG, "regression")
    models = {k: m for k, (m, _) in M.fit_trials(prepared, "ridge_regression", [{"alpha": 5.0}]).items()}
    for (t, i), got in M.measured(models, prepared, "regression").items():
        want = E.regression_metrics(M.score_frame(models[t, i], prepared[i][1], "regression"), "label", "prediction").first()
        assert got == pytest.approx(want.asDict())
    M.release(prepared)


@pytest.mark.parametrize("losses, patience, rounds", [
    ([5, 4, 3, 2], 2, 4), ([5, 4, 4.5, 4.4, 1], 2, 2), ([5, 4, 4.5, 3.9, 4, 4], 2, 4), ([1, 2, 3], 50, 1), ([3, 3, 3, 3], 2, 1), ([2], 1, 1)])
def test_patience(losses, patience, rounds):
    assert M.patient_rounds(losses, patience) == rounds


def test_early_stopping_cuts_at_the_best_round(rows):
    df = rows.select((F.col("id") % 2).cast("int").alias("y"), F.rand(5).alias("u"), F.rand(6).alias("v")).persist()
    frames = [M.assemble(df.where(c), ["u", "v"], "y", [0, 1]).select("label", M.FEATURES_COL).persist() for c in ("u < 0.6", "u >= 0.6")]
    params = {"maxIter": 12, "maxDepth": 2, "seed": 1}
    whole = M.fit_estimator(*frames, "gbt_classifier", params, 100, 0.5, 2)
    losses = whole.evaluateEachIteration(frames[1])
    cut = M.fit_estimator(*frames, "gbt_classifier", {**params, "early_stopping": True, "patience": 3}, 100, 0.5, 2)
    assert cut.getNumTrees == M.patient_rounds(losses, 3)
    assert cut.evaluateEachIteration(frames[1]) == pytest.approx(losses[:cut.getNumTrees])


def test_date_formats(spark):
    df = spark.createDataFrame([("31.12.2020", "12/31/2020", "01/02/2021", "x", None, "2020-01-01 10:11:12"),
                                (None, "01/02/2021", "03/04/2021", "2020-01-01", None, "2020-01-02 00:00:00")],
                               "a string, b string, c string, d string, e string, f string")
    got = {r["column_name"]: (r["format"], r["status"], r["n_parsed"]) for r in S.date_formats(df).collect()}
    assert got == {"a": ("dd.MM.yyyy", "typed", 1), "b": ("MM/dd/yyyy", "typed", 2), "c": ("dd/MM/yyyy", "ambiguous", 2),
                   "d": (None, "text", 1), "e": (None, "text", 0), "f": ("yyyy-MM-dd HH:mm:ss", "typed", 2)}
    kinds = dict(S.with_dates(df).dtypes)
    assert [kinds[c] for c in "abcdef"] == ["timestamp", "timestamp", "string", "string", "string", "timestamp"]
    typed = S.with_dates(df, prefer=["MM/dd/yyyy"])
    assert typed.select(F.month("c").alias("m")).first()["m"] == 1
    assert S.date_formats(df.limit(0)).where("status <> 'text'").count() == 0


def test_hot_groups_are_not_shuffled(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("g"), F.col("id") % 400)).alias("g"),
                                  F.col("id").cast("double").alias("v"))
    assert G.hot_groups(df, "g") == ["hot"]
    stats = G.fit_group_aggregates(df, "g", ["v"])
    out = G.apply_group_aggregates(df, "g", stats)
    want = {r["g"]: (r["g_v_mean"], r["g_v_std"]) for r in stats.collect()} | {None: (None, 0.0)}
    rows = out.collect()
    assert len(rows) == 3000 and all((r["g_v_mean"], r["g_v_std"]) == want[r["g"]] for r in rows)
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    unseen = G.apply_group_aggregates(spark.createDataFrame([("new", 1.0), (None, 2.0)], "g string, v double"), "g", stats)
    assert {(r["g"], r["g_v_mean"], r["g_v_std"]) for r in unseen.collect()} == {("new", None, 0.0), (None, None, 0.0)}
