"""What training, tuning and threshold choice leave behind, as tables.

Each artefact is a folder: ``table`` holds its rows (leaderboard, trials or the chosen
threshold), ``params`` one JSON text per model, ``models/<name>`` the fitted preprocessing and
the fitted Spark ML model of each refitted entry. Everything is read back without the
object that wrote it. Rows are a handful per model, so a table is one file.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import io as S


def _save_rows(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(path)


def _save_models(spark: SparkSession, params: dict, models: dict, path: str) -> None:
    """``params``: model → parameter map; ``models``: model → (pipeline, model, features)."""
    rows = [(name, json.dumps(own, sort_keys=True), name in models) for name, own in params.items()]
    _save_rows(spark.createDataFrame(rows, "model_name string, params string, fitted boolean"), f"{path}/params")
    for name, (pipeline, model, _) in models.items():
        S.save_pipeline(pipeline, f"{path}/models/{name}/pipeline")
        S.save_model(model, f"{path}/models/{name}/model")


def _load_models(spark: SparkSession, path: str) -> tuple[dict, dict]:
    params, models = {}, {}
    for row in spark.read.parquet(f"{path}/params").collect():       # one row per model
        name = row["model_name"]
        params[name] = json.loads(row["params"])
        if row["fitted"]:
            pipeline = S.load_pipeline(spark, f"{path}/models/{name}/pipeline")
            models[name] = (pipeline, S.load_model(spark, f"{path}/models/{name}/model"), pipeline.feature_names())
    return params, models


def save_training(trainer, path: str) -> None:
    """A fitted ``ModelTrainer``: leaderboard, parameters and refitted models."""
    spark = trainer.leaderboard_.sparkSession
    _save_rows(trainer.leaderboard_, f"{path}/table")
    _save_models(spark, {name: r["params"] for name, r in trainer.cv_results_.items()}, trainer.models_, path)


def save_search(trials: DataFrame, best_params: dict, path: str) -> None:
    """The trials of one or more searches, and the best parameters by model; refitted
    models go in as ``best_params[name] = (params, refit)`` or ``(params, None)``."""
    _save_rows(trials, f"{path}/table")
    _save_models(trials.sparkSession, {name: p for name, (p, _) in best_params.items()},
                 {name: refit for name, (_, refit) in best_params.items() if refit is not None}, path)


def load_models(spark: SparkSession, path: str) -> tuple[DataFrame, dict, dict]:
    """(table, model → parameters, model → (pipeline, model, features)) of ``save_training``
    or ``save_search``; leaderboard rows come best first."""
    params, models = _load_models(spark, path)
    table = spark.read.parquet(f"{path}/table")
    if "primary_metric_value" in table.columns:
        errors = table.where("primary_metric_name IN ('rmse', 'mae', 'log_loss')").limit(1).count() > 0
        best = F.asc_nulls_last if errors else F.desc_nulls_last
        table = table.orderBy(best("primary_metric_value"), "model_name")
    return table, params, models


def save_threshold(best: DataFrame, model_name: str, path: str) -> None:
    """The row of ``evaluate.tune_threshold`` as (model_name, optimal_threshold, metric, best_score)."""
    _save_rows(best.select(F.lit(model_name).alias("model_name"), F.col("best_threshold").alias("optimal_threshold"),
                           "metric", "best_score"), f"{path}/table")


def load_threshold(spark: SparkSession, path: str) -> DataFrame:
    """The saved choice: one row."""
    return spark.read.parquet(f"{path}/table")
