"""Hyper-parameter search (H1-H6).

Parameter maps are drawn on the driver with a seeded generator (a few dozen
dictionaries); every trial is a cross-validation on Spark. The per-fold
preprocessing is fitted once and shared by all trials, the fits of all trials and
folds run as concurrent jobs, and all are scored and measured in one long frame.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .split import kept, kfold
from .train import (MODEL_ALIASES, cross_validate_many, fit_full, infer_task, prepare_folds, release, resolve)

# Search ranges per model, in Spark parameter names.
# ("loguniform", a, b): log-uniform in [a, b]; ("uniform", a, w): uniform in [a, a + w];
# ("randint", a, b): integer in [a, b) (upper bound exclusive); list: a choice.
RANDOM_SEARCH_SPACES = {
    "logistic_regression": {"C": ("loguniform", 1e-4, 10.0), "maxIter": [1000]},
    "ridge_regression": {"alpha": ("loguniform", 1e-4, 10.0)},
    "lasso_regression": {"alpha": ("loguniform", 1e-4, 10.0), "maxIter": [1000]},
    "random_forest_classifier": {"numTrees": ("randint", 100, 500), "maxDepth": ("randint", 3, 20),
                                 "minInstancesPerNode": ("randint", 1, 10),
                                 "featureSubsetStrategy": ["sqrt", "log2"]},
    "random_forest_regressor": {"numTrees": ("randint", 100, 500), "maxDepth": ("randint", 3, 20),
                                "minInstancesPerNode": ("randint", 1, 10),
                                "featureSubsetStrategy": ["sqrt", "log2"]},
    "gbt_classifier": {"maxIter": ("randint", 100, 500), "maxDepth": ("randint", 3, 10),
                       "stepSize": ("loguniform", 0.01, 0.3), "subsamplingRate": ("uniform", 0.6, 0.4),
                       "featureSubsetStrategy": ("uniform", 0.6, 0.4), "minInstancesPerNode": ("randint", 1, 10)},
    "gbt_regressor": {"maxIter": ("randint", 100, 500), "maxDepth": ("randint", 3, 10),
                      "stepSize": ("loguniform", 0.01, 0.3), "subsamplingRate": ("uniform", 0.6, 0.4),
                      "featureSubsetStrategy": ("uniform", 0.6, 0.4), "minInstancesPerNode": ("randint", 1, 10)},
}


def draw(space: dict, rng: random.Random) -> dict:
    """One parameter map from a space (H2)."""
    out = {}
    for k, spec in space.items():
        if isinstance(spec, list):
            out[k] = rng.choice(spec)
        elif spec[0] == "loguniform":
            out[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        elif spec[0] == "uniform":
            out[k] = spec[1] + rng.random() * spec[2]
        elif spec[0] == "randint":
            out[k] = rng.randrange(spec[1], spec[2])
        else:
            raise ValueError(f"Unknown distribution {spec[0]}")
        if k == "featureSubsetStrategy" and isinstance(out[k], float):
            out[k] = f"{out[k]:.4f}"
    return out


def param_maps(model_name: str, n_iter: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    key = MODEL_ALIASES.get(model_name, model_name)
    space = space or RANDOM_SEARCH_SPACES[key]
    rng = random.Random(seed)
    return [draw(space, rng) for _ in range(n_iter)]


# The usual scorer names (None: the task's own) -> metric here.
SCORERS = {
    "classification": {None: "roc_auc", "roc_auc": "roc_auc", "roc_auc_ovr": "roc_auc", "f1": "f1", "f1_macro": "f1",
                       "precision": "precision", "precision_macro": "precision", "recall": "recall", "recall_macro": "recall",
                       "accuracy": "accuracy", "log_loss": "log_loss", "neg_log_loss": "log_loss"},
    "regression": {None: "rmse", "rmse": "rmse", "neg_root_mean_squared_error": "rmse", "mae": "mae",
                   "neg_mean_absolute_error": "mae", "r2": "r2"},
}
_LOWER_IS_BETTER = {"rmse", "mae", "log_loss"}


def scoring_metric(task: str, config: dict | None = None) -> str:
    """H3: the metric of the configured scorer, else the task's own; an unknown name is an error."""
    asked = ((config or {}).get("tuning") or {}).get("scoring")
    found = SCORERS.get(task, {}).get(asked)
    if found is None:
        raise ValueError(f"no scorer {asked!r} for task {task!r}; known: {sorted(filter(None, SCORERS.get(task, {})))}")
    return found


def prepare_search(df: DataFrame, target: str, key: str, cv: int = 5, seed: int = 42,
                   prep_config: dict | None = None) -> dict:
    """Folds plus per-fold fitted preprocessing, shareable by several searches
    and baselines. Release with ``release_search``."""
    task = infer_task(df, target)
    strat = target if task == "classification" else None
    n = df.count()
    folded = kept(kfold(df, key, cv, stratify=strat, seed=seed, n_rows=n).drop(key), n)
    return {"task": task, "folded": folded, "cv": cv,
            "prepared": prepare_folds(folded, target, "fold", cv, prep_config, task)}


def release_search(ctx: dict) -> None:
    release(ctx["prepared"])
    ctx["folded"].unpersist()


def random_search(df: DataFrame, target: str, key: str, model_name: str, n_iter: int = 50, cv: int = 5,
                  seed: int = 42, prep_config: dict | None = None, scoring: str | None = None,
                  refit: bool = True, space: dict | None = None, shared: dict | None = None):
    """H1: n seeded draws, each cross-validated with fold-safe preprocessing; the
    best (direction by metric) is refitted on all rows. Returns (trials, best_params, refit).

    ``shared`` (from ``prepare_search``) reuses folds and per-fold preprocessing.
    """
    spark = df.sparkSession
    ctx = shared or prepare_search(df, target, key, cv, seed, prep_config)
    task, prepared = ctx["task"], ctx["prepared"]
    scoring = scoring_metric(task, {"tuning": {"scoring": scoring}})
    spec, _ = resolve(model_name)
    rows = []
    try:
        trials = [{**spec.defaults, **pm} for pm in param_maps(model_name, n_iter, seed, space)]
        found = cross_validate_many(prepared, model_name, trials, task)
        rows = [(i, model_name, json.dumps(p, sort_keys=True), metrics.get(scoring), secs) for i, (p, (metrics, secs)) in enumerate(zip(trials, found))]
    finally:
        if shared is None:
            release_search(ctx)
    trials = spark.createDataFrame(rows, "trial int, model_name string, params string, score double, seconds double")
    valid = [r for r in rows if r[3] is not None]
    if not valid:
        return trials, None, None
    lower = scoring in _LOWER_IS_BETTER
    best = min(valid, key=lambda r: (r[3] if lower else -r[3], r[0]))
    best_params = {**spec.defaults, **param_maps(model_name, n_iter, seed, space)[best[0]]}
    model = fit_full(df.drop(key), target, model_name, best_params, prep_config) if refit else None
    return trials, best_params, model


#: Both names run the seeded search here: the sequential sampler is single-machine.
METHODS = ("random_search", "optuna")


def run_tuning(df: DataFrame, target: str, key: str, model_name: str, config: dict, prep_config: dict | None = None):
    """H4: the search that ``config['tuning']`` describes."""
    wanted = {"method": METHODS[0], "n_trials": 50, "cv_folds": 5, "random_state": 42, "scoring": None,
              **(config.get("tuning") or {})}
    if wanted["method"] not in METHODS:
        raise ValueError(f"tuning method {wanted['method']!r} is none of {METHODS}")
    return random_search(df, target, key, model_name, n_iter=wanted["n_trials"], cv=wanted["cv_folds"],
                         seed=wanted["random_state"], prep_config=prep_config, scoring=wanted["scoring"])


def trial_table(trials: DataFrame, leaderboard: DataFrame, metric: str) -> DataFrame:
    """H5: per model the best trial by the direction of ``metric``, the baseline CV
    score and the gain, positive where the search is better."""
    lower = metric in _LOWER_IS_BETTER
    best = trials.groupBy("model_name").agg((F.min if lower else F.max)("score").alias("tuned_cv"))
    base = leaderboard.select("model_name", F.col(metric).alias("baseline_cv"))
    gain = (F.col("baseline_cv") - F.col("tuned_cv")) if lower else (F.col("tuned_cv") - F.col("baseline_cv"))
    return best.join(base, "model_name", "left").withColumn("gain", gain)
