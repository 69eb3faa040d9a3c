"""Training and cross-validation with Spark ML.

Folds are an integer column. In every fold the preprocessing pipeline is
fitted on the training part only and applied to both parts (no leakage);
the fold table is persisted once and released at the end. Folds run as concurrent
jobs. Model fitting is Spark ML (distributed); only metrics (a few numbers per fold) reach the driver.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import evaluate as E
from .prep import FeaturePipeline, qcol
from .split import kept, kfold

FEATURES_COL = "__features"


# --------------------------------------------------------------------------
# M1-M7: registry
# --------------------------------------------------------------------------

@dataclass
class ModelSpec:
    name: str
    task: str
    defaults: dict = field(default_factory=dict)


def _lr(p, n, label_sd):
    c = float(p.get("C", 1.0))
    return LogisticRegression(maxIter=int(p.get("maxIter", 1000)), regParam=1.0 / (c * max(n, 1)),
                              elasticNetParam=0.0, standardization=False, tol=float(p.get("tol", 1e-6)))


def _linreg(p, n, label_sd):
    return LinearRegression(regParam=0.0, elasticNetParam=0.0, standardization=False, solver=p.get("solver", "normal"))


def _ridge(p, n, label_sd):
    alpha = float(p.get("alpha", 1.0))
    return LinearRegression(regParam=alpha * (label_sd or 1.0) / max(n, 1), elasticNetParam=0.0,
                            standardization=False, solver=p.get("solver", "normal"))


def _lasso(p, n, label_sd):
    return LinearRegression(regParam=float(p.get("alpha", 1.0)), elasticNetParam=1.0, standardization=False,
                            maxIter=int(p.get("maxIter", 1000)))


def _rf(cls):
    def make(p, n, label_sd):
        return cls(numTrees=int(p.get("numTrees", 300)), maxDepth=int(p.get("maxDepth", 30)),
                   minInstancesPerNode=int(p.get("minInstancesPerNode", 1)),
                   featureSubsetStrategy=str(p.get("featureSubsetStrategy", "auto")),
                   seed=int(p.get("seed", 42)))
    return make


def _gbt(cls):
    def make(p, n, label_sd):
        kw = dict(maxIter=int(p.get("maxIter", 300)), stepSize=float(p.get("stepSize", 0.05)),
                  maxDepth=int(p.get("maxDepth", 6)), subsamplingRate=float(p.get("subsamplingRate", 0.8)),
                  featureSubsetStrategy=str(p.get("featureSubsetStrategy", "0.8")),
                  minInstancesPerNode=int(p.get("minInstancesPerNode", 1)), seed=int(p.get("seed", 42)))
        return cls(**kw)
    return make


# Model names, tasks and default hyper-parameters.
MODEL_REGISTRY = {
    "logistic_regression": (ModelSpec("logistic_regression", "classification", {"maxIter": 1000, "C": 1.0}), _lr),
    "linear_regression": (ModelSpec("linear_regression", "regression", {}), _linreg),
    "ridge_regression": (ModelSpec("ridge_regression", "regression", {"alpha": 1.0}), _ridge),
    "lasso_regression": (ModelSpec("lasso_regression", "regression", {"alpha": 1.0, "maxIter": 1000}), _lasso),
    "random_forest_classifier": (ModelSpec("random_forest_classifier", "classification",
                                           {"numTrees": 300, "maxDepth": 30}), _rf(RandomForestClassifier)),
    "random_forest_regressor": (ModelSpec("random_forest_regressor", "regression",
                                          {"numTrees": 300, "maxDepth": 30}), _rf(RandomForestRegressor)),
    "gbt_classifier": (ModelSpec("gbt_classifier", "classification",
                                 {"maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8,
                                  "featureSubsetStrategy": "0.8"}), _gbt(GBTClassifier)),
    "gbt_regressor": (ModelSpec("gbt_regressor", "regression",
                                {"maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8,
                                 "featureSubsetStrategy": "0.8"}), _gbt(GBTRegressor)),
}
# boosted-tree entries of the surveyed registry all map to Spark's GBT
MODEL_ALIASES = {"xgboost_classifier": "gbt_classifier", "lightgbm_classifier": "gbt_classifier",
                 "catboost_classifier": "gbt_classifier", "xgboost_regressor": "gbt_regressor",
                 "lightgbm_regressor": "gbt_regressor", "catboost_regressor": "gbt_regressor"}

# parameter names accepted on top of the Spark estimator's own
_EXTRA_PARAMS = {"C", "alpha", "seed", "solver", "early_stopping", "patience"}
#: Fixed value: rounds without a lower validation loss after which boosting ends.
PATIENCE = 50


def resolve(name: str) -> tuple[ModelSpec, callable]:
    key = MODEL_ALIASES.get(name, name)
    if key not in MODEL_REGISTRY:
        raise KeyError(f"Unknown model: {name}")
    return MODEL_REGISTRY[key]


def validate_param_overrides(name: str, overrides: dict) -> None:
    """M9: every override is a parameter of the model's Spark estimator, or one of ours."""
    if not overrides:
        return
    spec, make = resolve(name)
    known = {p.name for p in make(dict(spec.defaults), 100, 1.0).params} | _EXTRA_PARAMS
    unknown = sorted(set(overrides) - known)
    if unknown:
        raise ValueError(f"{name} has no parameter {', '.join(unknown)}; it takes {sorted(known)}")


def build_estimator(name: str, params: dict, n_rows: int, label_sd: float | None,
                    label: str = "label", features: str = FEATURES_COL):
    spec, make = resolve(name)
    est = make({**spec.defaults, **params}, n_rows, label_sd)
    return est.setLabelCol(label).setFeaturesCol(features)


# --------------------------------------------------------------------------
# M10-M14
# --------------------------------------------------------------------------

def infer_task(df: DataFrame, target: str, max_classes: int = 20) -> str:
    """M/Q10: text and boolean targets, and integers of at most ``max_classes`` values,
    are classes; everything else is a number."""
    kind = df.schema[target].dataType.typeName()
    if kind in ("string", "varchar", "char", "boolean"):
        return "classification"
    if kind not in ("byte", "short", "integer", "long"):
        return "regression"
    n = df.agg(F.count_distinct(qcol(target)).alias("n")).first()["n"]
    return "classification" if n <= max_classes else "regression"


#: Classes of one target; their list becomes literals of the plan.
MAX_CLASSES = 1000


def class_list(df: DataFrame, target: str) -> list:
    """The target's distinct values in order: class ``i`` of a model is the i-th value."""
    rows = df.select(qcol(target).alias("v")).where("v IS NOT NULL").distinct().orderBy("v").limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes")
    return [r["v"] for r in rows]


def assemble(df: DataFrame, features, label: str, classes: list | None = None) -> DataFrame:
    """Feature columns → one vector column. The label is a double: the class's place in
    ``classes``, or the value itself without them (NaN-free input assumed)."""
    feats = list(features)
    # generated names may hold dots (e.g. "l_tax__0.05"), which the assembler
    # would read as struct fields: assemble from positional aliases
    safe = [f"__f{i}" for i in range(len(feats))]
    keep = [qcol(c) for c in df.columns if c not in set(feats) and c != "label"]
    y = qcol(label)
    if classes:
        y = F.nullif(F.array_position(F.array(*[F.lit(v) for v in classes]), y), F.lit(0)) - 1
    x = df.select(*keep, *[qcol(c).cast("double").alias(s) for c, s in zip(feats, safe)], y.cast("double").alias("label"))
    va = VectorAssembler(inputCols=safe, outputCol=FEATURES_COL, handleInvalid="keep")
    return va.transform(x).drop(*safe)


def score_frame(model, df: DataFrame, task: str) -> DataFrame:
    """Predictions; for classes also the probability ``p1`` of the second one."""
    out = model.transform(df)
    if task == "classification":
        out = out.withColumn("p1", vector_to_array(F.col("probability"))[1])
    return out


def _label_stats(df: DataFrame, label: str):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(qcol(label).cast("double")).alias("sd"),
               F.count_distinct(qcol(label)).alias("k")).first()
    return r["n"], r["sd"], r["k"]


#: Fits that run as concurrent jobs.
WIDTH = 8
#: Feature values (8 bytes each) that make a partition of an assembled fold.
VALUES_A_PARTITION = 1_000_000
#: Feature values of a partition that an estimator is fitted on, at most.
FIT_VALUES = 4_000_000
#: Trials that are put into one long frame and measured in one go.
MEASURED_AT_ONCE = 25


def at_once(jobs, width: int = WIDTH) -> list:
    """Results of the callables in order; up to ``width`` run as concurrent Spark jobs."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPool(min(width, len(jobs))) as pool:
        return pool.map(lambda job: job(), jobs)


def patient_rounds(losses, patience: int) -> int:
    """M8: rounds to keep. Boosting ends when ``patience`` rounds in a row brought no lower
    loss on the validation rows; the ensemble is cut after the best round so far."""
    best, at = math.inf, 0
    for i, loss in enumerate(losses):
        if loss < best:
            best, at = loss, i
        elif i - at >= patience:
            break
    return at + 1


def spread(df: DataFrame, values: int) -> DataFrame:
    """Rows of ``values`` feature values dealt over enough partitions: fits keep their
    partitions and read one a task, so a partition may not grow with the table."""
    wanted = math.ceil(values / FIT_VALUES)
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def fit_estimator(train: DataFrame, valid: DataFrame | None, model_name: str, params: dict, n: int, label_sd, n_classes: int):
    """M6-M8: a fitted model on assembled frames.

    Spark's boosted classifier knows two classes: with more the forest of the
    registry stands in for it. With ``early_stopping`` a boosted model is judged after
    every round by its loss on ``valid`` and cut after its best round (``patient_rounds``,
    ``patience`` 50): the same seed grows the same first trees again.
    """
    name = MODEL_ALIASES.get(model_name, model_name)
    params = dict(params)
    early, patience = params.pop("early_stopping", False), int(params.pop("patience", PATIENCE))
    if name == "gbt_classifier" and n_classes > 2:
        spec, _ = resolve("random_forest_classifier")
        shared = {k: v for k, v in params.items() if k in ("seed", "minInstancesPerNode")}
        return build_estimator("random_forest_classifier", {**spec.defaults, **shared}, n, label_sd).fit(train)
    model = build_estimator(name, params, n, label_sd).fit(train)
    if early and valid is not None and name.startswith("gbt"):
        losses = model.evaluateEachIteration(valid, *(["squared"] if name.endswith("regressor") else []))
        rounds = patient_rounds(losses, patience)
        if rounds < len(losses):
            model = build_estimator(name, {**params, "maxIter": rounds}, n, label_sd).fit(train)
    return model


def score_folds(prepared: dict, model_name: str, params: dict, task: str) -> dict:
    """Fold → scored validation frame, the folds fitted as concurrent jobs."""
    return {i: score_frame(model, prepared[i][1], task)
            for (_, i), (model, _) in fit_trials(prepared, model_name, [params]).items()}


def fit_trials(prepared: dict, model_name: str, trials: list[dict]) -> dict:
    """(trial, fold) → (fitted model, seconds of the fit); all fits of all trials
    share the prepared folds and run as concurrent jobs."""
    def job(params, i):
        train, valid, _, n, sd, n_classes = prepared[i]

        def run():
            began = time.time()
            return fit_estimator(train, valid, model_name, params, n, sd, n_classes), time.time() - began
        return run

    keys = [(t, i) for t in range(len(trials)) for i in prepared]
    return dict(zip(keys, at_once([job(trials[t], i) for t, i in keys])))


def scored_by_trial(models: dict, prepared: dict, task: str, n_classes: int) -> DataFrame:
    """(trial, fold, label, prediction[, p1 or probs]) of models by (trial, fold): every
    validation row passes all trials' models of its fold in one go."""
    out = None
    for i, (_, valid, *_) in prepared.items():
        frame, items = valid.select("label", FEATURES_COL), []
        for t in (t for t, j in models if j == i):
            model = models[t, i].copy().setPredictionCol(f"prediction{t}")
            fields = [F.lit(t).alias("trial"), F.col(f"prediction{t}").cast("double").alias("prediction")]
            if task != "regression":
                model = model.setProbabilityCol(f"probability{t}").setRawPredictionCol(f"raw{t}")
                probs = vector_to_array(f"probability{t}")
                fields.append(probs[1].alias("p1") if n_classes <= 2 else probs.alias("probs"))
            frame = model.transform(frame)
            items.append(F.struct(*fields))
        part = frame.select(F.lit(i).alias("fold"), "label", F.explode(F.array(*items)).alias("t")).select("t.*", "fold", "label")
        out = part if out is None else out.unionByName(part)
    return out


def measured(models: dict, prepared: dict, task: str) -> dict:
    """(trial, fold) → metrics, ``MEASURED_AT_ONCE`` trials in one long frame keyed by trial
    and fold: one job for each kind of metric, whatever the number of trials and folds."""
    n_classes = max(p[5] for p in prepared.values())
    found, trials = {}, sorted({t for t, _ in models})
    for lo in range(0, len(trials), MEASURED_AT_ONCE):
        chunk = set(trials[lo:lo + MEASURED_AT_ONCE])
        long = scored_by_trial({k: m for k, m in models.items() if k[0] in chunk}, prepared, task, n_classes)
        long = long.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found |= E.metrics_by(long, ["trial", "fold"], task, n_classes)
        finally:
            long.unpersist()
    return found


def mean_metrics(found: dict, trial: int) -> dict:
    """The mean of each metric over the folds of a trial, missing values ignored."""
    own = [m for (t, _), m in found.items() if t == trial]
    means = {}
    for metric in own[0]:
        values = [m[metric] for m in own if m[metric] is not None and m[metric] == m[metric]]
        means[metric] = sum(values) / len(values) if values else None
    return means


def cross_validate_many(prepared: dict, model_name: str, trials: list[dict], task: str) -> list[tuple[dict, float]]:
    """(mean metrics, seconds of its fits) of every parameter map."""
    fitted = fit_trials(prepared, model_name, trials)
    found = measured({k: model for k, (model, _) in fitted.items()}, prepared, task)
    return [(mean_metrics(found, t), sum(s for (u, _), (_, s) in fitted.items() if u == t)) for t in range(len(trials))]


def cross_validate(df: DataFrame, target: str, model_name: str, params: dict, folds_col: str = "fold",
                   k: int = 5, prep_config: dict | None = None, task: str | None = None,
                   prepared: dict | None = None) -> tuple[dict, float]:
    """The mean of each metric over the folds (missing values ignored) and wall time;
    ``prepared`` lets several models share the per-fold preprocessing."""
    task = task or infer_task(df, target)
    began = time.time()
    own = prepared is None
    prepared = prepare_folds(df, target, folds_col, k, prep_config, task) if own else prepared
    try:
        [(means, _)] = cross_validate_many(prepared, model_name, [params], task)
    finally:
        if own:
            release(prepared)
    return means, time.time() - began


def prepare_folds(df: DataFrame, target: str, folds_col: str, k: int, prep_config: dict | None, task: str | None = None,
                  keep=()) -> dict:
    """fold → (train, valid, features, rows, label sd, classes): the preprocessing is fitted
    on each training part alone and both parts are kept assembled, with the columns ``keep``,
    in partitions of no less than ``VALUES_A_PARTITION`` feature values where there are so many:
    an iterative fit runs one task a partition in each iteration."""
    rows = {r[folds_col]: r["count"] for r in df.groupBy(folds_col).count().collect()}
    classes = class_list(df, target) if (task or infer_task(df, target)) == "classification" else None

    def job(i):
        def run():
            train, valid = (df.where(c).drop(folds_col) for c in (F.col(folds_col) != i, F.col(folds_col) == i))
            pipe = FeaturePipeline(prep_config).fit(train.drop(*keep), target)
            feats = pipe.feature_names()
            held = rows.get(i, 0)
            frames = [assemble(pipe.transform(part), feats, target, classes).select("label", FEATURES_COL, *keep)
                      .coalesce(max(1, math.ceil(size * len(feats) / VALUES_A_PARTITION))).persist(StorageLevel.MEMORY_AND_DISK)
                      for part, size in ((train, sum(rows.values()) - held), (valid, held))]
            n, sd, seen = _label_stats(frames[0], "label")
            return (*frames, feats, n, sd, len(classes) if classes else seen)
        return run

    return dict(enumerate(at_once([job(i) for i in range(k)])))


def release(prepared: dict) -> None:
    for tr, va, *_ in prepared.values():
        tr.unpersist()
        va.unpersist()


def out_of_fold(df: DataFrame, target: str, key: str, model_name: str, params: dict | None = None, cv: int = 5, seed: int = 42,
                prep_config: dict | None = None) -> DataFrame:
    """``(key, fold, label, prediction[, p1])``: every row scored by the model that did
    not see it. Thresholds are to be chosen on these."""
    task = infer_task(df, target)
    spec, _ = resolve(model_name)
    folded = kfold(df, key, cv, stratify=target if task == "classification" else None, seed=seed)
    prepared = prepare_folds(folded, target, "fold", cv, prep_config, task, keep=(key,))
    scored = score_folds(prepared, model_name, {**spec.defaults, **(params or {})}, task)
    columns = [key, "fold", "label", "prediction"] + ["p1"] * (task == "classification")
    out = None
    for i, frame in scored.items():
        part = frame.withColumn("fold", F.lit(i)).select(*columns)
        out = part if out is None else out.unionByName(part)
    return out


def fit_full(df: DataFrame, target: str, model_name: str, params: dict, prep_config: dict | None = None, selected=None):
    """Preprocessing + model fitted on all training rows; (pipeline, model, features).

    ``selected`` (a list of features) refits on these alone, as after a selection (Q16).
    """
    config = dict(prep_config or {})
    if selected is not None:
        config["feature_selection"] = {"selected_features": list(selected)}
    pipe = FeaturePipeline(config).fit(df, target)
    feats = pipe.feature_names()
    classes = class_list(df, target) if infer_task(df, target) == "classification" else None
    x = assemble(pipe.transform(df), feats, target, classes)
    n, sd, seen = _label_stats(x, "label")
    dealt = spread(df, n * len(feats))
    if dealt is not df:
        x = assemble(pipe.transform(dealt), feats, target, classes)
    return pipe, fit_estimator(x, None, model_name, params, n, sd, len(classes) if classes else seen), feats


LEADERBOARD_COLUMNS = ["model_name", "primary_metric_name", "primary_metric_value", "roc_auc", "f1", "precision",
                       "recall", "accuracy", "log_loss", "rmse", "mae", "r2", "training_time_sec"]


def leaderboard(spark, results: dict, task: str) -> DataFrame:
    """Models by their primary metric, from model → {metrics, training_time_sec}."""
    metrics = LEADERBOARD_COLUMNS[3:-1]
    primary = E.primary_metric_name(task)
    rows = [(name, metric, found) for name, r in results.items() for metric, found in r["metrics"].items() if metric in metrics]
    times = spark.createDataFrame([(name, float(r["training_time_sec"])) for name, r in results.items()],
                                  "model_name string, training_time_sec double")
    wide = (spark.createDataFrame(rows, "model_name string, metric string, value double")
            .groupBy("model_name").pivot("metric", metrics).agg(F.first("value")))
    order = F.asc_nulls_last if task == "regression" else F.desc_nulls_last
    return (times.join(wide, "model_name", "left").withColumn("primary_metric_name", F.lit(primary))
            .withColumn("primary_metric_value", F.col(primary)).select(*LEADERBOARD_COLUMNS)
            .orderBy(order("primary_metric_value"), "model_name"))


class ModelTrainer:
    """Cross-validates the registry's models of the task (or ``models``),
    refits each on all rows and ranks them."""

    def __init__(self, seed: int = 42):
        self.seed = seed
        self.task_ = None
        self.leaderboard_ = None
        self.models_ = {}
        self.cv_results_ = {}

    def fit(self, df: DataFrame, target: str, key: str, prep_config: dict | None = None,
            param_overrides: dict | None = None, cv: int = 5, models=None, refit: bool = True) -> "ModelTrainer":
        self.task_ = infer_task(df, target)
        wanted = {}
        for name in models or [n for n, (spec, _) in MODEL_REGISTRY.items() if spec.task == self.task_]:
            changed = (param_overrides or {}).get(name, {})
            validate_param_overrides(name, changed)
            wanted[name] = {**resolve(name)[0].defaults, **changed}
        n = df.count()
        folded = kept(kfold(df, key, cv, stratify=target if self.task_ == "classification" else None,
                            seed=self.seed, n_rows=n).drop(key), n)
        prepared = prepare_folds(folded, target, "fold", cv, prep_config, self.task_)
        try:
            for name, params in wanted.items():
                means, seconds = cross_validate(folded, target, name, params, "fold", cv, prep_config, self.task_, prepared)
                self.cv_results_[name] = {"metrics": means, "training_time_sec": seconds, "params": params}
        finally:
            release(prepared)
            folded.unpersist()
        if refit:
            self.models_ = {name: fit_full(df.drop(key), target, name, params, prep_config) for name, params in wanted.items()}
        self.leaderboard_ = leaderboard(df.sparkSession, self.cv_results_, self.task_)
        return self

    def best(self) -> DataFrame:
        return self.leaderboard_.limit(1)
