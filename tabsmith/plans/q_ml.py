"""Catalog: training, tuning, attribution and sinks (M*, H*, L3/L4/L6/L7, E18/E19, S*).

Model fits are checked by row counts and invariants (no exact SQL twin),
except the single-feature least-squares line, which has a closed form.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import select as L
from ..operators import train as M
from ..operators import tune as H
from ..session import checkpoint_dir
from ..sources import artefacts
from ..sources import io as S
from .catalog import R, SCORED_SQL, T, mix, r, register, scored
from .q_eval import _M, _threshold_counts_sql
from .q_prep import _md5_mod_sql

FAST_TREES = {"random_forest_classifier": {"numTrees": 20, "maxDepth": 5},
              "gbt_classifier": {"maxIter": 20, "maxDepth": 3},
              "random_forest_regressor": {"numTrees": 20, "maxDepth": 5},
              "gbt_regressor": {"maxIter": 20, "maxDepth": 3}}
PREP = {"scaler": "standard", "hashing_dim": 8}


def labelled_docs(spark, sf_dir):
    """Documents with a quality label: (doc_id, lang, source, n_chars, quality)."""
    d = T(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.join(T(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


def order_prices(spark, sf_dir):
    """Orders with the price as regression target."""
    return T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                             "o_orderdate", "o_totalprice")


@register("m3_linear_closed_form", """
SELECT (floor(regr_slope(l_extendedprice, l_quantity) * 1e4 + 0.5) / 1e4) AS slope,
       (floor(regr_intercept(l_extendedprice, l_quantity) * 1e4 + 0.5) / 1e4) AS intercept FROM lineitem""")
def linear_closed_form_q(spark, sf_dir):
    """M3: Spark ML linear regression on one feature equals the least-squares line."""
    li = T(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    x = M.assemble(li, ["l_quantity"], "l_extendedprice")
    n, sd, _ = M._label_stats(x, "label")
    model = M.build_estimator("linear_regression", {}, n, sd).fit(x)
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))],
                                 "slope double, intercept double").select(R("slope", 4).alias("slope"),
                                                                          R("intercept", 4).alias("intercept"))


@register("m12_leaderboard_classification")
def leaderboard_cls_q(spark, sf_dir):
    """5-fold CV (preprocessing fitted per fold) of LR, RF and GBT on labelled documents."""
    tr = M.ModelTrainer(seed=42).fit(labelled_docs(spark, sf_dir), "quality", key="doc_id", prep_config=PREP,
                                     param_overrides=FAST_TREES, cv=5, refit=False)
    return tr.leaderboard_


@register("m12_leaderboard_regression")
def leaderboard_reg_q(spark, sf_dir):
    """5-fold CV of linear, ridge and lasso regression of the order price."""
    tr = M.ModelTrainer(seed=42).fit(order_prices(spark, sf_dir), "o_totalprice", key="o_orderkey",
                                     prep_config=PREP, cv=5, refit=False,
                                     models=["linear_regression", "ridge_regression", "lasso_regression"])
    return tr.leaderboard_


@register("m14_scores")
def scores_q(spark, sf_dir):
    """Fit preprocessing + logistic regression on D-MIX, score every row."""
    df = mix(spark, sf_dir)
    pipe, model, feats = M.fit_full(df, "is_returned", "logistic_regression", {}, PREP)
    x = M.assemble(pipe.transform(df), feats, "is_returned")
    s = M.score_frame(model, x, "classification")
    return s.select("is_returned", "prediction", R("p1").alias("p1"))


@register("h1_random_search")
def random_search_q(spark, sf_dir):
    """H1-H3: seeded random search (50 draws, 5 folds) of logistic regression's C."""
    trials, best, _ = H.random_search(labelled_docs(spark, sf_dir), "quality", "doc_id", "logistic_regression",
                                      n_iter=50, cv=5, prep_config=PREP, refit=False)
    return trials.select("trial", "model_name", "params", R("score").alias("score"))


@register("l3_l7_tree_importance")
def tree_importance_q(spark, sf_dir):
    """Random-forest importances of the preprocessed D-MIX features, top 20."""
    df = mix(spark, sf_dir)
    pipe, model, feats = M.fit_full(df, "is_returned", "random_forest_classifier", {"numTrees": 20, "maxDepth": 5}, PREP)
    return L.top_importances(L.tree_importances(spark, model, feats), 20)


@register("l4_permutation_importance")
def permutation_q(spark, sf_dir):
    """L4: AUC drop when one feature is permuted (exact distributed permutation)."""
    df = labelled_docs(spark, sf_dir)
    pipe, model, feats = M.fit_full(df.drop("doc_id"), "quality", "logistic_regression", {}, PREP)

    def score(long):
        x = M.assemble(pipe.transform(long.drop("doc_id")), feats, "quality")
        found = E.metrics_by(M.score_frame(model, x, "classification"), ["__variant"], "classification")
        return {variant: m["roc_auc"] or 0.0 for (variant,), m in found.items()}

    return L.permutation_importance(df, ["n_chars", "lang", "source"], "doc_id", score)


@register("l4_permuted_linear_score", """
WITH b AS (SELECT c_acctbal, c_nationkey, row_number() OVER (ORDER BY md5('42|' || c_custkey)) AS k FROM customer),
d AS (SELECT c_acctbal AS pa, c_nationkey AS pn, row_number() OVER (ORDER BY md5('43|' || c_custkey)) AS k FROM customer),
e AS (SELECT sum(abs(c_acctbal - pa)) AS ea, sum(abs(100.0 * (c_nationkey - pn))) AS en FROM b JOIN d USING (k))
SELECT 'c_acctbal' AS feature, floor(ea * 1e2 + 0.5) / 1e2 AS score FROM e UNION ALL
SELECT 'c_nationkey', floor(en * 1e2 + 0.5) / 1e2 FROM e""")
def permuted_linear_q(spark, sf_dir):
    """L4: the permutation itself, with a fixed linear score of two customer columns that is
    its own target: each feature's drop is the sum of the absolute errors its permutation makes."""
    df = T(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    score = F.col("c_acctbal") + 100.0 * F.col("c_nationkey")
    df = df.withColumn("y", score)

    def negative_error(long):
        rows = long.groupBy("__variant").agg((-F.sum(F.abs(F.col("y") - score))).alias("m")).collect()
        return {row["__variant"]: row["m"] for row in rows}

    return L.permutation_importance(df, ["c_acctbal", "c_nationkey"], "c_custkey", negative_error).select(
        "feature", R("score", 2).alias("score"))


@register("l6_attribution_rows")
def attribution_rows_q(spark, sf_dir):
    """Per-row exact attributions of a fitted linear model on orders."""
    df = order_prices(spark, sf_dir)
    pipe, model, feats = M.fit_full(df.drop("o_orderkey"), "o_totalprice", "ridge_regression", {}, PREP)
    x = pipe.transform(df)
    row = x.agg(*[F.avg(F.col(f"`{f}`").cast("double")).alias(f"m{i}") for i, f in enumerate(feats)]).collect()[0]
    means = {f: row[f"m{i}"] for i, f in enumerate(feats)}
    out = L.attribution_rows(x, feats, list(model.coefficients), means)
    return out.select("o_orderkey", *[R(F.col(f"`{f}__attr`"), 4).alias(f"{f}__attr") for f in feats])


@register("e18_e19_stage_comparison")
def stage_comparison_q(spark, sf_dir):
    """Baseline CV vs tuned CV vs held-out AUC per model, and the tuning gain."""
    df = labelled_docs(spark, sf_dir)
    from ..operators.split import kept, train_test_split
    n = df.count()
    split = kept(train_test_split(df, "doc_id", 0.2, stratify="quality", n_rows=n), n)
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    ctx = H.prepare_search(train, "quality", "doc_id", cv=3, prep_config=PREP)   # folds shared by both stages
    try:
        base_metrics, secs = M.cross_validate(ctx["folded"], "quality", "logistic_regression",
                                              dict(M.resolve("logistic_regression")[0].defaults), "fold", 3, PREP,
                                              ctx["task"], ctx["prepared"])
        trials, best, refit = H.random_search(train, "quality", "doc_id", "logistic_regression", n_iter=3, cv=3,
                                              prep_config=PREP, shared=ctx)
    finally:
        H.release_search(ctx)
    lb = spark.createDataFrame([("logistic_regression", base_metrics.get("roc_auc"), base_metrics.get("roc_auc"))],
                               "model_name string, roc_auc double, primary_metric_value double")
    pipe, model, feats = refit
    s = M.score_frame(model, M.assemble(pipe.transform(test.drop("doc_id")), feats, "quality"), "classification")
    test_auc = E.roc_auc(s, "label", "p1").collect()[0]["roc_auc"]
    split.unpersist()
    base = lb.select("model_name", F.col("roc_auc").alias("value"))
    tuned = trials.groupBy("model_name").agg(F.max("score").alias("value"))
    tst = spark.createDataFrame([("logistic_regression", test_auc)], "model_name string, value double")
    comp = E.stage_comparison(base, tuned, tst)
    gain = H.trial_table(trials, lb, "roc_auc").select("model_name", R("gain").alias("gain"))
    return comp.join(gain, "model_name", "left").select("model_name", "stage", R("value").alias("value"), "gain")


# --------------------------------------------------------------------------
# S: sources and sinks (scratch space under the shared checkpoint folder)
# --------------------------------------------------------------------------

def _scratch(spark) -> str:
    return os.path.join(checkpoint_dir(spark), "tabsmith-io", uuid.uuid4().hex)


@register("s1_s3_csv_typed_read", """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 13 <> 0 THEN c_nationkey END AS c_nationkey,
  'double' AS acctbal_type, 'bigint' AS nationkey_type FROM customer""")
def csv_q(spark, sf_dir):
    """Customer written as CSV with '?' and 'n/a' tokens and a -9 sentinel,
    read back: tokens become NULL before typing, so numeric columns stay numeric."""
    c = T(spark, sf_dir, "customer")
    noisy = c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 == 0, F.lit("?")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit("n/a")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 13 == 0, F.lit(-9)).otherwise(F.col("c_nationkey")).alias("c_nationkey"))
    path = _scratch(spark)
    S.write_table(noisy, path, fmt="csv")
    back = S.read_csv(spark, path, na_values=[-9])
    types = dict(back.dtypes)
    return back.select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey",
                       F.lit(types["c_acctbal"]).alias("acctbal_type"), F.lit(types["c_nationkey"]).alias("nationkey_type"))


@register("s7_s8_persist_roundtrip", f"""
WITH s AS (SELECT avg(o_custkey) AS mc, stddev_samp(o_custkey) AS sc, avg(o_totalprice) AS mp, stddev_samp(o_totalprice) AS sp FROM orders)
SELECT {r('(o_custkey - mc) / sc')} AS o_custkey, {r('(o_totalprice - mp) / sp')} AS o_totalprice,
  CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus__F", CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus__O",
  CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus__P", o_orderkey FROM orders, s""")
def persist_q(spark, sf_dir):
    """Fitted preprocessing as a parameter table and the transformed frame as
    parquet, written and re-read; every column comes from the reloaded pipeline."""
    df = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    from ..operators.prep import FeaturePipeline
    p = FeaturePipeline(PREP).fit(df.drop("o_orderkey"))
    base = _scratch(spark)
    S.save_pipeline(p, os.path.join(base, "pipeline"))
    p2 = S.load_pipeline(spark, os.path.join(base, "pipeline"))
    out = p2.transform(df)
    S.write_table(out, os.path.join(base, "features"))
    back = S.read_table(spark, os.path.join(base, "features"))
    return back.select(*[R(f"`{c}`").alias(c) if t == "double" else F.col(f"`{c}`") for c, t in back.dtypes])


@register("s7_scores_after_reload")
def reload_q(spark, sf_dir):
    """Preprocessing and model saved, loaded and applied; every row's
    score, and whether it equals the score before saving."""
    df = mix(spark, sf_dir)
    pipe, model, feats = M.fit_full(df, "is_returned", "logistic_regression", {}, PREP)
    base = _scratch(spark)
    S.save_pipeline(pipe, os.path.join(base, "pipeline"))
    S.save_model(model, os.path.join(base, "model"))
    pipe2, model2 = S.load_pipeline(spark, os.path.join(base, "pipeline")), S.load_model(spark, os.path.join(base, "model"))

    def scores(p, m, name):
        x = M.assemble(p.transform(df.withColumn("row", F.xxhash64(*df.columns))), p.feature_names(), "is_returned")
        return M.score_frame(m, x, "classification").select("row", F.col("p1").alias(name)).distinct()

    return scores(pipe, model, "before").join(scores(pipe2, model2, "after"), "row").select(
        "row", R("after").alias("p1"), (F.col("before") == F.col("after")).alias("same"))


@register("m10_pipeline_model_reload", """
SELECT l_quantity, count(*) AS n, (floor((SELECT regr_slope(l_extendedprice, l_quantity) * x.l_quantity
  + regr_intercept(l_extendedprice, l_quantity) FROM lineitem) * 1e3 + 0.5) / 1e3) AS prediction
FROM lineitem x GROUP BY l_quantity""")
def pipeline_model_q(spark, sf_dir):
    """Preprocessing and least squares as one Spark ML Pipeline, saved, loaded and
    applied; its predictions lie on the closed-form line."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.regression import LinearRegression

    from ..operators.stages import TabularFeatures
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    model = Pipeline(stages=[
        TabularFeatures(config=PREP, target="l_extendedprice", ignored=["l_orderkey"], outputCol="x"),
        LinearRegression(featuresCol="x", labelCol="l_extendedprice", solver="normal")]).fit(li)
    path = _scratch(spark)
    model.write().overwrite().save(path)
    scored_rows = PipelineModel.load(path).transform(li)
    return (scored_rows.select("l_quantity", R("prediction", 3).alias("prediction"))
            .groupBy("l_quantity", "prediction").agg(F.count(F.lit(1)).alias("n")))


@register("s9_threshold_reload", _threshold_counts_sql() + f""",
b AS (SELECT threshold, {_M['f2']} AS best FROM c ORDER BY best DESC, threshold LIMIT 1)
SELECT 'quantity' AS model_name, 'f2' AS metric, threshold AS optimal_threshold, {r('best')} AS best_score,
  (SELECT count(*) FROM {SCORED_SQL} WHERE p >= threshold) AS n_positive FROM b""")
def threshold_artefact_q(spark, sf_dir):
    """The tuned threshold written as an artefact, read back and applied to every row."""
    s, path = scored(spark, sf_dir), _scratch(spark)
    artefacts.save_threshold(E.tune_threshold(s, "y", "p", "f2", 101), "quantity", path)
    chosen = artefacts.load_threshold(spark, path)                   # one row
    positive = s.crossJoin(F.broadcast(chosen)).agg(F.count_if(F.col("p") >= F.col("optimal_threshold")).alias("n_positive"))
    return chosen.crossJoin(F.broadcast(positive)).select("model_name", "metric", "optimal_threshold",
                                                          R("best_score").alias("best_score"), "n_positive")


@register("s9_training_reload", """
SELECT l_quantity, count(*) AS n, (floor((SELECT regr_slope(l_extendedprice, l_quantity) * x.l_quantity
  + regr_intercept(l_extendedprice, l_quantity) FROM lineitem) * 1e3 + 0.5) / 1e3) AS prediction, 'linear_regression' AS model_name,
  'rmse' AS primary_metric_name FROM lineitem x GROUP BY l_quantity""")
def training_artefact_q(spark, sf_dir):
    """A trainer's leaderboard, parameters and refitted models written as tables and
    read back; the best reloaded model scores every row on the closed-form line."""
    li = T(spark, sf_dir, "lineitem").select(F.struct("l_orderkey", "l_linenumber").cast("string").alias("row"),
                                             "l_quantity", "l_extendedprice")
    path = _scratch(spark)
    artefacts.save_training(M.ModelTrainer().fit(li, "l_extendedprice", key="row", prep_config=PREP, cv=3,
                                                 models=["linear_regression"]), path)
    board, _, models = artefacts.load_models(spark, path)
    best = board.first()
    pipe, model, feats = models[best["model_name"]]
    x = M.assemble(pipe.transform(li.withColumn("quantity", F.col("l_quantity"))), feats, "l_extendedprice")
    return (M.score_frame(model, x, "regression").select(F.col("quantity").alias("l_quantity"), R("prediction", 3).alias("prediction"))
            .groupBy("l_quantity", "prediction").agg(F.count(F.lit(1)).alias("n"))
            .withColumns({"model_name": F.lit(best["model_name"]), "primary_metric_name": F.lit(best["primary_metric_name"])}))


@register("e8_primary_metric", f"""
SELECT 'regression' AS task, 'rmse' AS metric, {r('sqrt(avg((p_retailprice - 900.0 - 10.0 * p_size) ** 2))', 6)} AS value FROM part
UNION ALL SELECT 'classification', 'roc_auc', {r('sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg))', 6)} FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
    SELECT p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM {SCORED_SQL} GROUP BY p))""")
def primary_metric_q(spark, sf_dir):
    """The metric that ranks models of each task, taken from all metrics of two fixed scores."""
    part = T(spark, sf_dir, "part").select(F.col("p_retailprice").alias("y"), (900.0 + 10.0 * F.col("p_size")).alias("pred"))
    s = scored(spark, sf_dir).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    measured = {"regression": E.regression_metrics(part, "y", "pred"),
                "classification": E.classification_metrics(s, "y", "p", "pred")}
    rows = [(task, *E.extract_primary_metric(task, m.first().asDict())) for task, m in measured.items()]
    return spark.createDataFrame(rows, "task string, metric string, value double").select(
        "task", "metric", R("value", 6).alias("value"))


@register("h5_trial_table", """
WITH x AS (SELECT l_linestatus AS model_name, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity / 50.0 AS p FROM lineitem),
t AS (SELECT model_name, i, avg(CAST(CAST(p >= i / 10.0 AS INTEGER) = y AS DOUBLE)) AS score FROM x, range(1, 10) g(i) GROUP BY 1, 2)
SELECT model_name, (floor(max(score) * 1e8 + 0.5) / 1e8) AS tuned_cv,
  (floor(max(score) FILTER (i = 5) * 1e8 + 0.5) / 1e8) AS baseline_cv,
  (floor((max(score) - max(score) FILTER (i = 5)) * 1e8 + 0.5) / 1e8) AS gain FROM t GROUP BY 1""")
def trial_table_q(spark, sf_dir):
    """H5: best trial against the baseline by model; a trial is a cut of the fixed score,
    its value the accuracy over all rows of a line status, and the baseline cuts at 0.5."""
    li = T(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("model_name"),
                                             (F.col("l_returnflag") == "R").alias("y"), (F.col("l_quantity") / 50.0).alias("p"))
    cuts = F.explode(F.array(*[F.lit(i) for i in range(1, 10)])).alias("trial")
    trials = (li.select("*", cuts).groupBy("model_name", "trial")
              .agg(F.avg(((F.col("p") >= F.col("trial") / 10.0) == F.col("y")).cast("double")).alias("score")))
    base = trials.where("trial = 5").select("model_name", F.col("score").alias("accuracy"))
    return H.trial_table(trials, base, "accuracy").select("model_name", *[R(c).alias(c) for c in ("tuned_cv", "baseline_cv", "gain")])


@register("h4_run_tuning")
def run_tuning_q(spark, sf_dir):
    """H4: the search that a configuration describes (ridge regression of the order price,
    6 draws, 3 folds, by mean absolute error), its trials saved and read back (S9)."""
    config = {"tuning": {"method": "random_search", "n_trials": 6, "cv_folds": 3, "scoring": "mae"}}
    trials, best, refit = H.run_tuning(order_prices(spark, sf_dir), "o_totalprice", "o_orderkey", "ridge_regression", config, PREP)
    path = _scratch(spark)
    artefacts.save_search(trials, {"ridge_regression": (best, refit)}, path)
    back, params, _ = artefacts.load_models(spark, path)
    return back.select("trial", "model_name", "params", R("score", 4).alias("score"),
                       F.lit(params["ridge_regression"]["alpha"]).alias("best_alpha"))


@register("s3_date_formats", """
SELECT * FROM (VALUES ('day_first', 'typed', 'dd.MM.yyyy'), ('month_first', 'typed', 'MM/dd/yyyy'), ('iso', 'typed', 'yyyy-MM-dd'),
  ('either', 'ambiguous', 'dd/MM/yyyy'), ('text', 'text', NULL)) t(column_name, status, format)
  JOIN (SELECT count(*) AS n_nonnull, CAST(sum(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE))) AS BIGINT) AS days FROM orders) ON true""")
def date_formats_q(spark, sf_dir):
    """Orders written as CSV with dates in four formats and read back: the format
    chosen for each column, and the sum of the days read by the columns that were typed."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    d = F.col("o_orderdate")
    low = F.make_date(F.year(d), F.month(d), F.least(F.dayofmonth(d), F.lit(12)))
    path = _scratch(spark)
    S.write_table(o.select("o_orderkey", F.date_format(d, "dd.MM.yyyy").alias("day_first"), F.date_format(d, "MM/dd/yyyy").alias("month_first"),
                           F.date_format(d, "yyyy-MM-dd").alias("iso"), F.date_format(low, "dd/MM/yyyy").alias("either"),
                           F.col("o_orderpriority").alias("text")), path, fmt="csv")
    raw = spark.read.option("header", True).csv(path)
    back = S.read_csv(spark, path, dates=True)
    kinds = dict(back.dtypes)
    days = [F.sum(F.datediff(F.col(c).cast("date"), F.lit("1992-01-01").cast("date"))).alias(c) for c in ("day_first", "month_first", "iso")]
    assert [kinds[c] for c in ("day_first", "month_first", "iso", "either")] == ["timestamp"] * 3 + ["string"]
    same = back.agg(*days).select(F.when((F.col("day_first") == F.col("iso")) & (F.col("month_first") == F.col("iso")), F.col("iso")).alias("days"))
    report = S.date_formats(raw, ["day_first", "month_first", "iso", "either", "text"])
    return report.crossJoin(F.broadcast(same)).select("column_name", "status", "format", "n_nonnull", "days")


@register("s10_json_report", f"""
WITH x AS (SELECT y, p, CAST(p >= 0.5 AS INTEGER) AS pred FROM {SCORED_SQL}),
k AS (SELECT avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM x)
SELECT {r('accuracy')} AS accuracy, true AS has_time FROM k""")
def report_q(spark, sf_dir):
    """Machine-readable report (time stamp + metrics) written as JSON and read back."""
    m = E.classification_metrics(scored(spark, sf_dir).withColumn("pred", (F.col("p") >= 0.5).cast("int")),
                                 "y", "p", "pred").collect()[0].asDict()
    path = _scratch(spark)
    S.save_json_report(spark, m, path)
    return spark.read.json(path).select(R("metrics.accuracy").alias("accuracy"),
                                        F.col("generated_at").isNotNull().alias("has_time"))


# --------------------------------------------------------------------------
# Streaming: a fitted pipeline applied to a file stream
# --------------------------------------------------------------------------

@register("st1_stream_transform", f"""
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT event_id, {r('(value - m) / sd')} AS value, CAST(year(ts) AS INTEGER) AS ts__year, CAST(hour(ts) AS INTEGER) AS ts__hour,
  CAST({_md5_mod_sql('props', 8)} AS BIGINT) AS props_bucket FROM events, s""")
def stream_transform_q(spark, sf_dir):
    """F22 on a stream: a pipeline fitted on the events table (batch) transforms the
    same table, file or folder, read as a stream and written to a table. The hash
    columns are folded into the bucket they name."""
    from ..operators.prep import FeaturePipeline
    from ..streaming.scoring import file_stream, run_to_table, transform_stream
    batch = T(spark, sf_dir, "events")
    p = FeaturePipeline(PREP).fit(batch.drop("event_id"))
    stream = file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", batch.schema)
    out = run_to_table(transform_stream(p, stream))
    hashes = [c for c in out.columns if c.startswith("props__hash_")]
    bucket = sum((F.col(c).cast("long") * i for i, c in enumerate(hashes)), F.lit(0).cast("long"))
    return out.select("event_id", R("value").alias("value"), "ts__year", "ts__hour", bucket.alias("props_bucket"))
