"""Results that once were wrong."""

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import engineer as G
from tabsmith.operators import evaluate as E
from tabsmith.operators import profile as P
from tabsmith.operators import tune as H
from tabsmith.operators.prep import FeaturePipeline, correlation_filter


def test_large_integers_stay_apart(spark):
    df = spark.createDataFrame([(2 ** 53 + i,) for i in range(10)], "id long")
    counts = P.value_counts_long(df, ["id"])
    assert counts.count() == 10 and counts.agg(F.max("cnt")).first()[0] == 1


def test_custom_date_formats_are_parsed(spark):
    df = spark.createDataFrame([(f"{1 + i % 28:02d}/03/2021 10:{i % 60:02d}", i) for i in range(40)], "t string, n int")
    p = FeaturePipeline({"datetime_formats": ["dd/MM/yyyy HH:mm"]}).fit(df)
    out = p.transform(df).agg(F.min("t__year"), F.max("t__year"), F.max("t__missing"), F.max("t__hour")).first()
    assert tuple(out) == (2021, 2021, 0, 10)


def test_integer_products_do_not_overflow(spark):
    df = spark.createDataFrame([(100_000, 100_000)], "a int, b int")
    assert G.add_interactions(df, [("a", "b")]).first()["a_x_b"] == 1e10
    assert G.add_polynomials(df, ["a"], 3).first()["a_pow2"] == 1e10


def test_trials_follow_the_metric(spark):
    trials = spark.createDataFrame([("m", 5.0), ("m", 9.0)], "model_name string, score double")
    base = spark.createDataFrame([("m", 6.0)], "model_name string, rmse double")
    r = H.trial_table(trials, base, "rmse").first()
    assert (r["tuned_cv"], r["gain"]) == (5.0, 1.0)
    r = H.trial_table(trials, base.withColumnRenamed("rmse", "roc_auc"), "roc_auc").first()
    assert (r["tuned_cv"], r["gain"]) == (9.0, 3.0)


def test_scorer_names():
    assert H.scoring_metric("regression", {"tuning": {"scoring": "neg_root_mean_squared_error"}}) == "rmse"
    assert H.scoring_metric("classification") == "roc_auc"
    for task, name in (("classification", "nonsense"), ("ranking", None)):
        with pytest.raises(ValueError):
            H.scoring_metric(task, {"tuning": {"scoring": name}})


def test_threshold_metrics_carry_auc_and_log_loss(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), (0, 0.6), (1, 0.8), (1, 0.4), (0, 0.3), (1, 0.9), (0, 0.2)], "y int, p double")
    rows = E.metrics_at_thresholds(df, "y", "p", [0.5, 0.35]).collect()
    assert all(r["roc_auc"] == 0.9375 and r["log_loss"] > 0 for r in rows)


def test_correlated_columns(spark):
    df = spark.range(50).selectExpr("id * 1.0 AS a", "id * 2.0 AS b", "id * 3.0 AS c", "pmod(id * 7919, 13) * 1.0 AS d")
    assert correlation_filter(df, ["a", "b", "c", "d"], 0.9) == ["a", "d"]
    assert correlation_filter(df, ["a", "b", "c", "d"], 0.9, ["c"]) == ["c", "d"]
    assert correlation_filter(df, ["a", "b", "c", "d"], 0.9, ["a", "c"]) == ["a", "d"]


def test_typing_without_the_profile_agrees(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("t", F.col("ts").cast("string"))
    for df, target in ((li, "y"), (ev, None), (li.limit(0), "y"), (li.select(F.lit(None).cast("double").alias("e"), "l_linenumber"), None)):
        names = ["position", "column_name", "feature_type"]
        full, fast = (f(df, target=target).select(*names).orderBy("position").collect() for f in (P.detect_feature_types, P.typed_columns))
        assert full == fast
