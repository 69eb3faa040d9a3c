"""Catalog: metrics, thresholds and evaluation tables (E*) on fixed scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from .catalog import R, SCORED_SQL, T, r, register, scored

# Per distinct score: positives, negatives and the negatives strictly below.
_SC = f"""(SELECT p AS score, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
FROM {SCORED_SQL} WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY 1)"""


@register("e1_roc_auc", f"""
SELECT {r('CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) END')} AS roc_auc
FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM {_SC})""",
          headline=True)
def roc_auc_q(spark, sf_dir):
    """Exact ROC-AUC with ties counted one half."""
    return E.roc_auc(scored(spark, sf_dir), "y", "p").select(R("roc_auc").alias("roc_auc"))


# one score for each of the ten classes from ALL components: class c adds up components c, c + 10, ...
_EMB = ("(SELECT label, [list_sum([CAST(x AS DOUBLE) FOR x, i IN embedding IF (i - 1) % 10 = c]) FOR c IN range(0, 10)] AS s "
        "FROM embeddings)")


def class_scores(spark, sf_dir):
    """Embeddings as (label, s): ten class scores from all components."""
    s = F.expr("transform(sequence(0, 9), c -> aggregate(filter(embedding, (x, i) -> i % 10 = c), 0D, "
               "(a, x) -> a + CAST(x AS DOUBLE)))")
    return T(spark, sf_dir, "embeddings").select("label", s.alias("s"))


@register("e2_roc_auc_ovr", f"""
WITH long AS (SELECT CAST(label AS INTEGER) AS y, CAST(i - 1 AS INTEGER) AS cls, CAST(s[i] AS DOUBLE) AS score
              FROM {_EMB}, range(1, 11) t(i)),
sc AS (SELECT cls, score, sum(CASE WHEN y = cls THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = cls THEN 0 ELSE 1 END) AS neg
       FROM long GROUP BY 1, 2),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY cls ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc),
per AS (SELECT cls, sum(pos) AS np, sum(neg) AS nn, sum(pos * (nb + 0.5 * neg)) AS u FROM cum GROUP BY 1 HAVING sum(pos) > 0)
SELECT {r('CASE WHEN count(*) = count(CASE WHEN nn > 0 THEN 1 END) THEN avg(CASE WHEN nn > 0 THEN u / (np * nn) END) END')} AS roc_auc FROM per""")
def roc_auc_ovr_q(spark, sf_dir):
    """Macro one-vs-rest AUC over ten classes."""
    return E.roc_auc_ovr(class_scores(spark, sf_dir), "label", "s").select(R("roc_auc").alias("roc_auc"))


_PRED = f"(SELECT y, p, CAST(p >= 0.5 AS INTEGER) AS pred FROM {SCORED_SQL})"


def _label_metrics_sql(src):
    return f"""
WITH cm AS (SELECT y AS t, pred AS q, count(*) AS c FROM {src} GROUP BY 1, 2),
cls AS (SELECT t AS k FROM cm UNION SELECT q FROM cm),
pc AS (SELECT k, coalesce((SELECT sum(c) FROM cm WHERE t = k AND q = k), 0) AS tp,
              coalesce((SELECT sum(c) FROM cm WHERE q = k), 0) AS np, coalesce((SELECT sum(c) FROM cm WHERE t = k), 0) AS nt FROM cls),
m AS (SELECT CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS pr, CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS rc FROM pc)
SELECT {r('avg(pr)')} AS precision, {r('avg(rc)')} AS recall,
  {r('avg(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END)')} AS f1,
  {r(f'(SELECT avg(CAST(y = pred AS DOUBLE)) FROM {src})')} AS accuracy FROM m"""


@register("e3_e4_label_metrics", _label_metrics_sql(_PRED))
def label_metrics_q(spark, sf_dir):
    """Macro precision, recall, F1 and accuracy at threshold 0.5."""
    s = scored(spark, sf_dir).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    m = E.label_metrics(s, "y", "pred")
    return m.select(R("precision").alias("precision"), R("recall").alias("recall"), R("f1").alias("f1"),
                    R("accuracy").alias("accuracy"))


@register("e5_log_loss", f"""
SELECT {r('CASE WHEN count(DISTINCT y) = 2 THEN avg(-(y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) + (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))) END')} AS log_loss
FROM (SELECT CAST(y AS DOUBLE) AS y, p FROM {SCORED_SQL})""")
def log_loss_q(spark, sf_dir):
    """E5: binary log loss with clipped probabilities."""
    return E.log_loss(scored(spark, sf_dir), "y", "p").select(R("log_loss").alias("log_loss"))


_REG = "(SELECT p_partkey, p_retailprice AS y, 900.0 + 10.0 * p_size AS pred FROM part)"


@register("e6_regression_metrics", f"""
SELECT {r('sqrt(avg((y - pred) * (y - pred)))', 6)} AS rmse, {r('avg(abs(y - pred))', 6)} AS mae,
  {r('CASE WHEN var_pop(y) * count(*) > 0 THEN 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) WHEN sum((y - pred) * (y - pred)) = 0 THEN 1.0 ELSE 0.0 END')} AS r2
FROM {_REG} WHERE y IS NOT NULL AND pred IS NOT NULL""")
def regression_q(spark, sf_dir):
    """RMSE, MAE and R² of a fixed prediction (900 + 10 * size) of the retail price."""
    p = T(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("y"),
                                        (900.0 + 10.0 * F.col("p_size")).alias("pred"))
    m = E.regression_metrics(p, "y", "pred")
    return m.select(R("rmse", 6).alias("rmse"), R("mae", 6).alias("mae"), R("r2").alias("r2"))


@register("e7_regression_summary", f"""
SELECT {r('avg(abs(y - pred))', 6)} AS mae, {r('avg((y - pred) * (y - pred))', 4)} AS mse, {r('sqrt(avg((y - pred) * (y - pred)))', 6)} AS rmse,
  {r('1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*))')} AS r2
FROM {_REG}""")
def regression_summary_q(spark, sf_dir):
    """The regression summary (adds MSE)."""
    p = T(spark, sf_dir, "part").select(F.col("p_retailprice").alias("y"), (900.0 + 10.0 * F.col("p_size")).alias("pred"))
    m = E.regression_metrics(p, "y", "pred", with_mse=True)
    return m.select(R("mae", 6).alias("mae"), R("mse", 4).alias("mse"), R("rmse", 6).alias("rmse"), R("r2").alias("r2"))


def _threshold_counts_sql(n=101):
    step = f"(1.0 / {n - 1})"
    return f"""
WITH g AS (SELECT CAST(i AS INTEGER) AS i, CASE WHEN i = {n - 1} THEN 1.0 ELSE i * {step} END AS threshold FROM range({n}) t(i)),
s AS (SELECT y, p FROM {SCORED_SQL} WHERE y IS NOT NULL AND p IS NOT NULL),
c AS (SELECT g.i, g.threshold, count_if(s.p >= g.threshold AND s.y = 1) AS tp, count_if(s.p >= g.threshold AND s.y <> 1) AS fp,
             count_if(s.p < g.threshold AND s.y = 1) AS fn, count_if(s.p < g.threshold AND s.y <> 1) AS tn
      FROM g, s GROUP BY 1, 2)"""


def _metric_sql():
    tp, fp, fn, tn = "CAST(tp AS DOUBLE)", "CAST(fp AS DOUBLE)", "CAST(fn AS DOUBLE)", "CAST(tn AS DOUBLE)"
    prec = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0.0 END"
    rec = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0.0 END"

    def fb(b):
        b2 = b * b
        den = f"((1 + {b2}) * {tp} + {b2} * {fn} + {fp})"
        return f"CASE WHEN {den} > 0 THEN (1 + {b2}) * {tp} / {den} ELSE 0.0 END"
    acc = f"({tp} + {tn}) / ({tp} + {fp} + {fn} + {tn})"
    return {"precision": prec, "recall": rec, "f1": fb(1.0), "f2": fb(2.0), "f3": fb(3.0), "accuracy": acc}


_M = _metric_sql()


@register("e9_threshold_curve", _threshold_counts_sql() + f"""
SELECT i, round(threshold, 4) AS threshold, {r(_M['precision'])} AS precision, {r(_M['recall'])} AS recall,
  {r(_M['f1'])} AS f1, {r(_M['accuracy'])} AS accuracy FROM c""")
def threshold_curve_q(spark, sf_dir):
    """Precision, recall, F1 and accuracy of ``p >= t`` at 101 thresholds."""
    c = E.threshold_curve(scored(spark, sf_dir), "y", "p", 101)
    return c.select("i", "threshold", R("precision").alias("precision"), R("recall").alias("recall"),
                    R("f1").alias("f1"), R("accuracy").alias("accuracy"))


@register("e10_best_threshold", _threshold_counts_sql() + ",\n" + ",\n".join(
    f"b_{m} AS (SELECT '{m}' AS metric, threshold AS best_threshold, {e} AS best_score, CAST(tp + fp + fn + tn AS BIGINT) AS n_samples "
    f"FROM c ORDER BY best_score DESC, threshold LIMIT 1)" for m, e in _M.items()) + "\n" + "\nUNION ALL\n".join(
    f"SELECT metric, best_threshold, {r('best_score')} AS best_score, n_samples, n_samples < 200 AS warning FROM b_{m}" for m in _M))
def best_threshold_q(spark, sf_dir):
    """Best threshold for each of f1, f2, f3, precision, recall, accuracy (lowest wins ties)."""
    s = scored(spark, sf_dir)
    out = None
    for m in E.THRESHOLD_METRICS:
        b = E.tune_threshold(s, "y", "p", m, 101).select(
            "metric", "best_threshold", R("best_score").alias("best_score"), "n_samples", "warning")
        out = b if out is None else out.unionByName(b)
    return out


@register("e11_default_vs_tuned", f"""
WITH best AS ({_threshold_counts_sql()}
  SELECT threshold FROM c ORDER BY {_M['f1']} DESC, threshold LIMIT 1),
ts AS (SELECT 0.5 AS threshold UNION ALL SELECT threshold FROM best),
x AS (SELECT ts.threshold, y, CAST(p >= ts.threshold AS INTEGER) AS pred FROM {SCORED_SQL}, ts),
cm AS (SELECT threshold, y AS t, pred AS q, count(*) AS c FROM x GROUP BY 1, 2, 3),
cls AS (SELECT threshold, t AS k FROM cm UNION SELECT threshold, q FROM cm),
pc AS (SELECT cls.threshold, k,
  coalesce((SELECT sum(c) FROM cm WHERE cm.threshold = cls.threshold AND t = k AND q = k), 0) AS tp,
  coalesce((SELECT sum(c) FROM cm WHERE cm.threshold = cls.threshold AND q = k), 0) AS np,
  coalesce((SELECT sum(c) FROM cm WHERE cm.threshold = cls.threshold AND t = k), 0) AS nt FROM cls),
m AS (SELECT threshold, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS pr, CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS rc,
             CASE WHEN np + nt > 0 THEN 2.0 * tp / (np + nt) ELSE 0.0 END AS f FROM pc)
SELECT threshold, {r('avg(pr)')} AS precision, {r('avg(rc)')} AS recall, {r('avg(f)')} AS f1,
  {r('(SELECT avg(CAST(x.y = x.pred AS DOUBLE)) FROM x WHERE x.threshold = m.threshold)')} AS accuracy,
  (SELECT {r('sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg))')} FROM (SELECT *, coalesce(sum(neg) OVER
    (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM {_SC})) AS roc_auc,
  (SELECT {r('avg(-(y * ln(c) + (1 - y) * ln(1 - c)))', 6)} FROM (SELECT y, least(greatest(p, {E.LOG_LOSS_EPS!r}), 1 - {E.LOG_LOSS_EPS!r}) AS c
    FROM {SCORED_SQL})) AS log_loss
FROM m GROUP BY threshold""")
def default_vs_tuned_q(spark, sf_dir):
    """Macro metrics at the default threshold 0.5 and at the F1-tuned threshold."""
    s = scored(spark, sf_dir)
    best = E.tune_threshold(s, "y", "p", "f1").collect()[0]["best_threshold"]
    m = E.metrics_at_thresholds(s, "y", "p", [0.5, best])
    return m.select("threshold", R("precision").alias("precision"), R("recall").alias("recall"),
                    R("f1").alias("f1"), R("accuracy").alias("accuracy"), R("roc_auc").alias("roc_auc"),
                    R("log_loss", 6).alias("log_loss"))


@register("e12_roc_points", f"""
WITH c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
                  sum(pos) OVER () AS pp, sum(neg) OVER () AS nn FROM {_SC})
SELECT 'inf'::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT score, {r('fp / nn')}, {r('tp / pp')} FROM c""")
def roc_points_q(spark, sf_dir):
    """ROC curve points at every distinct score."""
    p = E.roc_points(scored(spark, sf_dir), "y", "p")
    return p.select("threshold", R("fpr").alias("fpr"), R("tpr").alias("tpr"))


@register("e13_pr_points", f"""
WITH c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
                  sum(pos) OVER () AS pp FROM {_SC})
SELECT score AS threshold, {r('tp / (tp + fp)')} AS precision, {r('tp / pp')} AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""")
def pr_points_q(spark, sf_dir):
    """precision–recall points at every distinct score plus the final (1, 0) point."""
    p = E.pr_points(scored(spark, sf_dir), "y", "p")
    return p.select("threshold", R("precision").alias("precision"), R("recall").alias("recall"))


@register("e14_confusion_matrix", f"""
SELECT label AS y_true, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS y_pred, count(*) AS count
FROM """ + _EMB + """ GROUP BY 1, 2""")
def confusion_q(spark, sf_dir):
    """Multiclass confusion counts (prediction: arg-max of the class scores)."""
    emb = class_scores(spark, sf_dir)
    pred = (F.array_position("s", F.array_max("s")) - 1).cast("int")
    return E.confusion_long(emb.withColumn("y_pred", pred), "label", "y_pred")


@register("e16_residuals", f"SELECT p_partkey, {r('y - pred', 6)} AS residual FROM {_REG}")
def residuals_q(spark, sf_dir):
    """Residual per row."""
    p = T(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("y"),
                                        (900.0 + 10.0 * F.col("p_size")).alias("pred"))
    return E.residuals(p, "y", "pred").select("p_partkey", R("residual", 6).alias("residual"))


@register("e17_residual_histogram", f"""
WITH d AS (SELECT y - pred AS x FROM {_REG}),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM d),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END AS wd FROM mm),
b AS (SELECT least(floor((x - lo) / wd) + 1, 30) AS bin, count(*) AS count FROM d, w WHERE x IS NOT NULL GROUP BY 1),
g AS (SELECT range + 1 AS bin FROM range(30))
SELECT CAST(g.bin AS INTEGER) AS bin, {r('lo + (g.bin - 1) * wd', 6)} AS lower, {r('lo + g.bin * wd', 6)} AS upper,
  coalesce(b.count, 0) AS count FROM g CROSS JOIN w LEFT JOIN b ON b.bin = g.bin""")
def residual_hist_q(spark, sf_dir):
    """30-bin histogram of the residuals."""
    p = T(spark, sf_dir, "part").select(F.col("p_retailprice").alias("y"), (900.0 + 10.0 * F.col("p_size")).alias("pred"))
    h = E.residual_histogram(p, "y", "pred", 30)
    return h.select("bin", R("lower", 6).alias("lower"), R("upper", 6).alias("upper"), "count")


@register("e15_predicted_vs_actual", f"SELECT y AS actual, pred AS predicted FROM {_REG}")
def pred_actual_q(spark, sf_dir):
    """(actual, predicted) pairs."""
    p = T(spark, sf_dir, "part").select(F.col("p_retailprice").alias("y"), (900.0 + 10.0 * F.col("p_size")).alias("pred"))
    return E.predicted_vs_actual(p, "y", "pred")
