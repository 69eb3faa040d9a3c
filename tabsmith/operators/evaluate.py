"""Metrics, thresholds and evaluation tables.

Scored rows carry a label column, a positive-class probability and/or a
predicted label. Every metric is an aggregation; curves are built from one
row per distinct score with running sums that never put the whole table in
one task (see ``ranking``).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qc

from .profile import histogram
from .ranking import running_sums

CLASSIFICATION_PRIMARY = "roc_auc"
REGRESSION_PRIMARY = "rmse"
THRESHOLD_METRICS = ["f1", "f2", "f3", "precision", "recall", "accuracy"]
LOG_LOSS_EPS = 2.220446049250313e-16     # float64 machine epsilon


def _c(x) -> Column:
    return qc(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------
# ROC-AUC (exact, tie-aware)
# --------------------------------------------------------------------------

def score_counts(df: DataFrame, label: str, score: str, partition_cols=()) -> DataFrame:
    """One row per distinct score: ``(score, pos, neg)``."""
    y = _c(label).cast("double")
    return (df.where(_c(score).isNotNull() & y.isNotNull())
            .groupBy(*partition_cols, _c(score).cast("double").alias("score"))
            .agg(F.sum(F.when(y == 1, 1).otherwise(0)).alias("pos"),
                 F.sum(F.when(y == 1, 0).otherwise(1)).alias("neg")))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve with ties counted as one half; NULL with one class.

    AUC = sum_s pos(s) * (neg(<s) + neg(s)/2) / (P * N).
    """
    sc = score_counts(df, label, score)
    rs = running_sums(sc, "score", ["neg"], inclusive=False)
    return rs.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("__u"),
    ).select(F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                    F.col("__u") / (F.col("n_pos") * F.col("n_neg"))).alias("roc_auc"))


def roc_auc_ovr(df: DataFrame, label: str, proba: str, classes: list | None = None) -> DataFrame:
    """Macro one-vs-rest AUC over classes; ``proba`` is a vector or array column
    with one probability per class index (class labels 0..K-1)."""
    arr = vector_to_array(qc(proba)) if dict(df.dtypes)[proba].startswith("vector") else qc(proba)
    long = df.select(_c(label).cast("int").alias("__y"), F.posexplode(arr).alias("cls", "score"))
    long = long.withColumn("is_c", (F.col("__y") == F.col("cls")).cast("int"))
    sc = score_counts(long, "is_c", "score", ["cls"])
    rs = running_sums(sc, "score", ["neg"], inclusive=False, partition_cols=["cls"])
    per = rs.groupBy("cls").agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("__u"))
    per = per.where(F.col("n_pos") > 0)        # classes absent from the labels are not scored
    auc = F.when(F.col("n_neg") > 0, F.col("__u") / (F.col("n_pos") * F.col("n_neg")))
    return per.select("cls", auc.alias("auc")).agg(
        F.when(F.count(F.lit(1)) == F.count("auc"), F.avg("auc")).alias("roc_auc"))


# --------------------------------------------------------------------------
# Label metrics
# --------------------------------------------------------------------------

def confusion_long(df: DataFrame, label: str, pred: str) -> DataFrame:
    """``(y_true, y_pred, count)`` for every observed pair."""
    return (df.groupBy(_c(label).alias("y_true"), _c(pred).alias("y_pred"))
            .agg(F.count(F.lit(1)).alias("count")))


def per_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per-class tp/fp/fn, precision, recall, f1 (zero on empty denominators).

    Classes are all labels seen in either column.
    """
    cm = confusion_long(df, label, pred)
    truth = cm.groupBy(F.col("y_true").alias("cls")).agg(F.sum("count").alias("n_true"))
    predicted = cm.groupBy(F.col("y_pred").alias("cls")).agg(F.sum("count").alias("n_pred"))
    tp = cm.where(F.col("y_true") == F.col("y_pred")).select(F.col("y_true").alias("cls"), F.col("count").alias("tp"))
    j = truth.join(predicted, "cls", "full").join(tp, "cls", "left").na.fill(0, ["n_true", "n_pred", "tp"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(0.0)
    j = j.select("cls", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"),
                 (F.col("n_true") - F.col("tp")).alias("fn"), prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return j.withColumn("f1", f1)


def label_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Macro precision, recall, F1 and accuracy in one row."""
    pc = per_class(df, label, pred).agg(F.avg("precision").alias("precision"),
                                         F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))
    acc = df.agg(F.avg((_c(label) == _c(pred)).cast("double")).alias("accuracy"))
    return pc.crossJoin(acc)


def log_loss(df: DataFrame, label: str, score: str, eps: float = LOG_LOSS_EPS) -> DataFrame:
    """E5 (binary): mean negative log-likelihood with clipped probabilities; NULL with one class."""
    y = _c(label).cast("double")
    p = F.least(F.greatest(_c(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    ll = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.agg(F.when(F.count_distinct(y) == 2, F.avg(ll)).alias("log_loss"))


def classification_metrics(df: DataFrame, label: str, score: str, pred: str) -> DataFrame:
    """E1 + E3-E5 as one row: roc_auc, f1, precision, recall, accuracy, log_loss."""
    return (roc_auc(df, label, score).crossJoin(label_metrics(df, label, pred))
            .crossJoin(log_loss(df, label, score))
            .select("roc_auc", "f1", "precision", "recall", "accuracy", "log_loss"))


# --------------------------------------------------------------------------
# regression
# --------------------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str, pred: str, with_mse: bool = False) -> DataFrame:
    """Rmse, mae, r2 (and mse). R² = 1 - SSE/SST; SST = 0 gives 1 when SSE = 0, else 0."""
    y, p = _c(label).cast("double"), _c(pred).cast("double")
    e = y - p
    a = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("sse"), (F.var_pop(y) * F.count(F.lit(1))).alias("sst"))
    r2 = (F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst"))
          .when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    cols = [F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2")]
    if with_mse:
        cols.insert(2, "mse")
    return a.select(*cols)


def residuals(df: DataFrame, label: str, pred: str) -> DataFrame:
    """``residual = y - pred`` per row (other columns kept)."""
    return df.withColumn("residual", _c(label).cast("double") - _c(pred).cast("double"))


def residual_histogram(df: DataFrame, label: str, pred: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram of the residuals."""
    return histogram(residuals(df, label, pred), "residual", bins)


def predicted_vs_actual(df: DataFrame, label: str, pred: str) -> DataFrame:
    """The (actual, predicted) pairs plus the identity line's range."""
    return df.select(_c(label).cast("double").alias("actual"), _c(pred).cast("double").alias("predicted"))


# --------------------------------------------------------------------------
# Primary metric
# --------------------------------------------------------------------------

PRIMARY = {"classification": CLASSIFICATION_PRIMARY, "regression": REGRESSION_PRIMARY}


def primary_metric_name(task: str) -> str:
    if task not in PRIMARY:
        raise ValueError(f"no primary metric for task {task!r}; tasks: {sorted(PRIMARY)}")
    return PRIMARY[task]


def extract_primary_metric(task: str, metrics: dict) -> tuple[str, float | None]:
    """The metric a task is ranked by, and its value where it was measured."""
    return (wanted := primary_metric_name(task)), metrics.get(wanted)


# --------------------------------------------------------------------------
# E1-E7 of many scored frames at once
# --------------------------------------------------------------------------

def metrics_by(scored: DataFrame, keys: list[str], task: str, n_classes: int = 2) -> dict[tuple, dict]:
    """{key values: metrics} of one long frame of scored rows, for example keyed by trial
    and fold: one running sum gives every AUC, one count every confusion matrix. Only
    these few numbers per key (``n_classes`` squared counts at most) are collected.

    Classification: columns label, prediction, and p1 (two classes) or probs (an array, one
    probability a class). Regression: label, prediction.
    """
    key = lambda r: tuple(r[k] for k in keys)
    if task == "regression":
        e = F.col("label") - F.col("prediction")
        rows = scored.where("label IS NOT NULL AND prediction IS NOT NULL").groupBy(*keys).agg(
            F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("sse"),
            (F.var_pop("label") * F.count(F.lit(1))).alias("sst")).collect()
        return {key(r): {"rmse": r["mse"] ** 0.5, "mae": r["mae"],
                         "r2": 1 - r["sse"] / r["sst"] if r["sst"] > 0 else float(r["sse"] == 0)} for r in rows}
    cells: dict[tuple, dict] = {}
    for r in scored.groupBy(*keys, "label", "prediction").count().collect():
        cells.setdefault(key(r), {})[r["label"], r["prediction"]] = r["count"]
    true = F.col("p1") if n_classes <= 2 else F.element_at("probs", F.col("label").cast("int") + 1)
    p = F.least(F.greatest(true, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    loss = -(F.col("label") * F.log(p) + (1 - F.col("label")) * F.log(1 - p)) if n_classes <= 2 else -F.log(p)
    losses = {key(r): r["loss"] for r in scored.groupBy(*keys).agg(F.avg(loss).alias("loss")).collect()}
    if n_classes <= 2:
        long, by = scored.select(*keys, F.lit(1).alias("cls"), F.col("label").alias("y"), F.col("p1").alias("score")), [*keys, "cls"]
    else:
        long, by = scored.select(*keys, "label", F.posexplode("probs").alias("cls", "score")), [*keys, "cls"]
        long = long.withColumn("y", (F.col("label") == F.col("cls")).cast("double"))
    sums = running_sums(score_counts(long, "y", "score", by), "score", ["neg"], inclusive=False, partition_cols=by)
    areas: dict[tuple, list] = {}
    for r in sums.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"),
                                   F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("u")).collect():
        if r["p"] or n_classes <= 2:
            areas.setdefault(key(r), []).append(r["u"] / (r["p"] * r["n"]) if r["p"] and r["n"] else None)
    out = {}
    for k, found in cells.items():
        classes = sorted({c for pair in found for c in pair})
        per = []
        for c in classes:
            tp = found.get((c, c), 0)
            said, was = (sum(n for pair, n in found.items() if pair[side] == c) for side in (1, 0))
            precision, recall = tp / said if said else 0.0, tp / was if was else 0.0
            per.append((precision, recall, 2 * precision * recall / (precision + recall) if precision + recall else 0.0))
        auc = areas.get(k, [None])
        out[k] = {"roc_auc": None if None in auc else sum(auc) / len(auc),
                  **{m: sum(x[i] for x in per) / len(per) for i, m in enumerate(("precision", "recall", "f1"))},
                  "accuracy": sum(n for (a, b), n in found.items() if a == b) / sum(found.values()),
                  "log_loss": losses[k] if len({a for a, _ in found}) > 1 else None}
    return out


# --------------------------------------------------------------------------
# thresholds
# --------------------------------------------------------------------------

def thresholds(n: int = 101) -> list[float]:
    """n evenly spaced thresholds in [0, 1] as ``i * step`` (last exactly 1)."""
    step = 1.0 / (n - 1)
    t = [i * step for i in range(n)]
    t[-1] = 1.0
    return t


def threshold_counts(df: DataFrame, label: str, score: str, n: int = 101) -> DataFrame:
    """Per threshold index i: tp, fp, fn, tn of ``score >= t_i``.

    Each row falls in bucket k = number of thresholds <= score; predicted
    positive at t_i means k >= i + 1. One aggregation over <= n buckets, then a
    reverse running sum over those few rows.
    """
    step = 1.0 / (n - 1)
    s = _c(score).cast("double")
    k0 = F.floor(s / F.lit(step)).cast("int")
    # exact count of thresholds i*step <= s (guards the floating floor both ways)
    k = (F.when((k0 + 1) * F.lit(step) <= s, k0 + 2)
         .when(k0 * F.lit(step) > s, k0)
         .otherwise(k0 + 1))
    k = F.least(F.greatest(k, F.lit(0)), F.lit(n))
    k = F.when(s >= 1.0, F.lit(n)).otherwise(k)
    y = _c(label).cast("double")
    b = (df.where(s.isNotNull() & y.isNotNull())
         .groupBy(k.alias("k")).agg(F.sum(F.when(y == 1, 1).otherwise(0)).alias("pos"),
                                    F.sum(F.when(y == 1, 0).otherwise(1)).alias("neg")))
    spark = df.sparkSession
    grid = spark.range(n).select(F.col("id").cast("int").alias("i"),
                                 (F.col("id").cast("double") * F.lit(step)).alias("threshold"))
    grid = grid.withColumn("threshold", F.when(F.col("i") == n - 1, F.lit(1.0)).otherwise(F.col("threshold")))
    tot = b.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # predicted positive at i: buckets k >= i+1 — a join against <= n+1 bucket rows
    j = grid.crossJoin(F.broadcast(b)).where(F.col("k") >= F.col("i") + 1)
    pp = j.groupBy("i").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp"))
    return (grid.join(pp, "i", "left").crossJoin(F.broadcast(tot)).na.fill(0, ["tp", "fp"])
            .select("i", "threshold", "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"),
                    (F.col("N") - F.col("fp")).alias("tn")))


def _metric_exprs():
    tp, fp, fn, tn = (qc(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)

    def fbeta(beta):
        b2 = beta * beta
        den = (1 + b2) * tp + b2 * fn + fp
        return F.when(den > 0, (1 + b2) * tp / den).otherwise(0.0)

    acc = (tp + tn) / (tp + fp + fn + tn)
    return {"precision": prec, "recall": rec, "f1": fbeta(1.0), "f2": fbeta(2.0), "f3": fbeta(3.0),
            "accuracy": acc}


def threshold_curve(df: DataFrame, label: str, score: str, n: int = 101) -> DataFrame:
    """Precision, recall, f1, accuracy of ``score >= t`` at n thresholds.

    ``threshold`` is rounded to 4 places for display; ``i`` is the exact index.
    """
    m = _metric_exprs()
    tc = threshold_counts(df, label, score, n)
    return tc.select("i", F.round("threshold", 4).alias("threshold"), m["precision"].alias("precision"),
                     m["recall"].alias("recall"), m["f1"].alias("f1"), m["accuracy"].alias("accuracy"))


def tune_threshold(df: DataFrame, label: str, score: str, metric: str = "f1", n: int = 101,
                   min_samples_warning: int = 200) -> DataFrame:
    """The threshold maximising ``metric``; the lowest threshold wins ties.

    One row: best_threshold, best_score, metric, n_samples, warning.
    """
    if metric not in THRESHOLD_METRICS:
        raise ValueError(f"thresholds are not tuned by {metric!r}, only by one of {', '.join(THRESHOLD_METRICS)}")
    m = _metric_exprs()
    tc = threshold_counts(df, label, score, n)
    scored = tc.select("threshold", m[metric].alias("score"), (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"))
    best = scored.orderBy(F.desc("score"), F.asc("threshold")).limit(1)
    return best.select(F.col("threshold").alias("best_threshold"), F.col("score").alias("best_score"),
                       F.lit(metric).alias("metric"), F.col("n").alias("n_samples"),
                       (F.col("n") < min_samples_warning).alias("warning"))


def metrics_at_thresholds(df: DataFrame, label: str, score: str, thresholds_list) -> DataFrame:
    """Macro precision/recall/F1 and accuracy at each threshold (``score >= t``), one
    row per threshold, with AUC and log loss of the score, which no threshold moves.
    Rows are repeated per threshold by an explode of a short literal array."""
    ts = F.array(*[F.lit(float(t)) for t in thresholds_list])
    x = df.select(_c(label).alias("__y"), _c(score).cast("double").alias("__p"), F.explode(ts).alias("threshold"))
    x = x.withColumn("__pred", (F.col("__p") >= F.col("threshold")).cast("int"))
    cm = x.groupBy("threshold", "__y", "__pred").agg(F.count(F.lit(1)).alias("cnt"))
    labels = F.array_distinct(F.array_union(F.collect_set("__y"), F.collect_set("__pred")))
    # per threshold: per-class precision/recall from the (bounded) confusion cells
    per_t = cm.groupBy("threshold").agg(
        F.collect_list(F.struct("__y", "__pred", "cnt")).alias("cells"), labels.alias("labels"),
        F.sum("cnt").alias("n"), F.sum(F.when(F.col("__y") == F.col("__pred"), F.col("cnt"))).alias("correct"))
    stats = F.expr("""transform(labels, c -> named_struct(
        'tp', aggregate(filter(cells, z -> z.__y = c and z.__pred = c), 0L, (a, z) -> a + z.cnt),
        'np', aggregate(filter(cells, z -> z.__pred = c), 0L, (a, z) -> a + z.cnt),
        'nt', aggregate(filter(cells, z -> z.__y = c), 0L, (a, z) -> a + z.cnt)))""")
    per_t = per_t.withColumn("st", stats)
    prec = F.expr("aggregate(st, 0D, (a, s) -> a + IF(s.np > 0, s.tp / s.np, 0D)) / size(st)")
    rec = F.expr("aggregate(st, 0D, (a, s) -> a + IF(s.nt > 0, s.tp / s.nt, 0D)) / size(st)")
    f1 = F.expr("""aggregate(st, 0D, (a, s) -> a + IF(s.np + s.nt > 0, 2D * s.tp / (s.np + s.nt), 0D)) / size(st)""")
    lab = per_t.select("threshold", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                       (F.coalesce(F.col("correct"), F.lit(0)) / F.col("n")).alias("accuracy"))
    whole = roc_auc(df, label, score).crossJoin(log_loss(df, label, score))      # one row
    return lab.crossJoin(whole).orderBy("threshold")


# --------------------------------------------------------------------------
# curves
# --------------------------------------------------------------------------

def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending, plus the
    (inf, 0, 0) start (no points are dropped)."""
    sc = score_counts(df, label, score)
    rs = running_sums(sc, "score", ["pos", "neg"], descending=True, inclusive=True)
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    pts = rs.crossJoin(F.broadcast(tot)).select(
        F.col("score").alias("threshold"),
        F.when(F.col("N") > 0, F.col("cum_neg") / F.col("N")).alias("fpr"),
        F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).alias("tpr"))
    start = tot.select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the final
    (precision 1, recall 0) point with a NULL threshold."""
    sc = score_counts(df, label, score)
    rs = running_sums(sc, "score", ["pos", "neg"], descending=True, inclusive=True)
    tot = sc.agg(F.sum("pos").alias("P"))
    pts = rs.crossJoin(F.broadcast(tot)).select(
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).alias("recall"))
    end = tot.select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                     F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


# --------------------------------------------------------------------------
# comparisons
# --------------------------------------------------------------------------

def stage_comparison(baseline: DataFrame, tuned: DataFrame, test: DataFrame, key: str = "model_name") -> DataFrame:
    """``(model_name, stage, value)`` from three ``(model_name, value)`` tables."""
    j = (baseline.withColumnRenamed("value", "baseline_cv")
         .join(tuned.withColumnRenamed("value", "tuned_cv"), key, "left")
         .join(test.withColumnRenamed("value", "test"), key, "left"))
    return j.unpivot([key], ["baseline_cv", "tuned_cv", "test"], "stage", "value")
