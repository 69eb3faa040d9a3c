"""Feature selection and attribution."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import field_kinds
from .prep import qcol

MI_BINS = 32


def binned_mi(df: DataFrame, features, target: str, bins: int = MI_BINS,
              bin_target: bool = False) -> DataFrame:
    """L1 scores: MI (nats) of each feature with the target, ``(feature, mi)``.

    Numeric features are cut at their exact quantiles into ``bins`` bins
    (bin = number of edges strictly below the value); string features are used
    as they are. With ``bin_target`` a numeric target is binned the same way
    (regression). All features are counted against the target in one scan, in arrays
    of counts.
    """
    kinds = field_kinds(df)
    features = list(features)
    numeric = [c for c in features if kinds[c] in ("numeric", "boolean")]
    probs = [i / bins for i in range(1, bins)]
    to_bin = numeric + ([target] if bin_target else [])
    edges = {}
    if to_bin:
        from .quantiles import quantile_arrays
        edges = quantile_arrays(df, to_bin, probs)               # exact, distributed
    from .assoc import _pair_margins, counted_cells
    m = _pair_margins(counted_cells(df, [(c, target) for c in features], edges))
    term = F.col("cnt") / F.col("n") * F.log(F.col("cnt") * F.col("n") / (F.col("n1") * F.col("n2")))
    return m.groupBy(F.col("f1").alias("feature")).agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mi"))


def top_percentile(scores: DataFrame, score_col: str, percentile: float, n_features: int) -> DataFrame:
    """Keep the first ``floor(n * p / 100)`` features by descending score (ties by name)."""
    k = int(n_features * (percentile / 100))
    return scores.orderBy(F.desc(score_col), "feature").limit(k)


def mutual_info_filter(df: DataFrame, features, target: str, task: str = "classification",
                       percentile: float = 50, bins: int = MI_BINS) -> tuple[list[str], DataFrame]:
    """L1: MI of every feature with the target; keep the top ``percentile`` %."""
    scores = binned_mi(df, features, target, bins, bin_target=(task == "regression"))
    ranked = scores.orderBy(F.desc("mi"), "feature")
    selected = [r["feature"] for r in top_percentile(scores, "mi", percentile, len(list(features))).collect()]
    return selected, ranked


def linear_attribution(df: DataFrame, features, coefficients, means: dict | None = None) -> DataFrame:
    """L2 (exact for linear models): mean |coef_j * (x_j - mean_j)| per feature.

    ``means`` default to the column means of ``df`` (the background data).
    One aggregation for the means, one for the attribution.
    """
    features = list(features)
    coefs = [float(c) for c in coefficients]
    if means is None:
        row = df.agg(*[F.avg(qcol(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).collect()[0]
        means = {c: row[f"m{i}"] for i, c in enumerate(features)}
    one = df.agg(*[F.avg(F.abs(F.lit(coefs[i]) * (qcol(c).cast("double") - F.lit(means[c] or 0.0)))).alias(f"a{i}")
                   for i, c in enumerate(features)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("score")) for i, c in enumerate(features)
    ])).alias("r")).select("r.*")


def attribution_rows(df: DataFrame, features, coefficients, means: dict) -> DataFrame:
    """Per-row attribution columns ``<feature>__attr`` for a linear model."""
    return df.select("*", *[(F.lit(float(coefficients[i])) * (qcol(c).cast("double") - F.lit(means[c] or 0.0)))
                            .alias(f"{c}__attr") for i, c in enumerate(features)])


def attribution_filter(scores: DataFrame, n_features: int, percentile: float = 80) -> tuple[list[str], DataFrame]:
    """L2-L4 cut: the top ``percentile`` % of ``(feature, score)`` rows."""
    ranked = scores.orderBy(F.desc("score"), "feature")
    sel = [r["feature"] for r in top_percentile(scores, "score", percentile, n_features).collect()]
    return sel, ranked


def tree_importances(spark, model, feature_names) -> DataFrame:
    """``featureImportances`` of a Spark ML tree model as ``(feature, score)``."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(feature_names, imp)], "feature string, score double")


def top_importances(scores: DataFrame, k: int = 20) -> DataFrame:
    """The k largest importances."""
    return scores.orderBy(F.desc("score"), "feature").limit(k)


def permutation_importance(df: DataFrame, features, key: str, score_fn, seed: int = 42) -> DataFrame:
    """L4 (re-aimed): drop of a metric when one feature is permuted.

    The permutation is exact and distributed: each row keeps its rank in one
    hash order and meets the features of the row of the same rank in a second hash
    order, in one join for all features. ``score_fn`` takes one long frame with the
    column ``__variant`` and returns {variant: metric}: variant 0 holds every row as it
    is, variant i every row with the i-th feature permuted.
    """
    from .split import hash_rank
    features, n = list(features), df.count()
    donor = (hash_rank(df.select(*[qcol(c) for c in dict.fromkeys([key, *features])]), key, None, seed + 1, n)
             .select("__rank", F.struct(*[qcol(c).alias(f"v{i}") for i, c in enumerate(features)]).alias("__perm")))
    both = hash_rank(df, key, None, seed, n).join(donor, "__rank").withColumn(
        "__variant", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    place = {c: i for i, c in enumerate(features)}
    long = both.select("__variant", *[
        F.when(F.col("__variant") == place[c] + 1, F.col(f"__perm.v{place[c]}")).otherwise(qcol(c)).alias(c) if c in place
        else qcol(c) for c in df.columns])
    found = score_fn(long) if n else {}
    rows = [(c, float(found[0] - found[i + 1])) for c, i in place.items()] if n else []
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def intersect_selection(attr_ranked: DataFrame, attr_selected, mi_selected) -> list[str]:
    """Features chosen by both filters, in attribution order."""
    mi = set(mi_selected)
    return [f for f in attr_selected if f in mi]
