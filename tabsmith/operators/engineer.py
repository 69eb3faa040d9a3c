"""Feature engineering.

Every transform is a single projection. Statistics that a transform needs
(bin edges, group means) are fitted on one frame and applied to any frame
(decisions Q4/Q5: train statistics are reused on test).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prep import qcol
from .profile import typed_columns, feature_type_map

MI_BINS = 32


def numeric_columns(df: DataFrame, target: str | None = None) -> list[str]:
    """G1: continuous numeric features (binary and low-cardinality excluded)."""
    cols = [c for c in df.columns if c != target]
    return feature_type_map(typed_columns(df.select(*cols)))["numeric"]


def categorical_columns(df: DataFrame, target: str | None = None) -> list[str]:
    """G1: categorical and high-cardinality features."""
    cols = [c for c in df.columns if c != target]
    ft = feature_type_map(typed_columns(df.select(*cols)))
    return ft["categorical"] + ft["high_cardinality"]


def interaction_pairs(numeric_cols, max_pairs: int) -> list[tuple[str, str]]:
    """The first ``max_pairs`` pairs in column order."""
    return list(combinations(list(numeric_cols), 2))[:max_pairs]


def rank_interaction_pairs(df: DataFrame, numeric_cols, target: str, max_pairs: int,
                           bins: int = MI_BINS) -> DataFrame:
    """All pair products scored by binned MI with the target in ONE
    long aggregation; ``(feature_1, feature_2, mi)`` of the top ``max_pairs``."""
    from .select import binned_mi
    pairs = list(combinations(list(numeric_cols), 2))
    prod = df.select(*[(qcol(a).cast("double") * qcol(b).cast("double")).alias(f"{a}_x_{b}") for a, b in pairs],
                     qcol(target).alias("__t"))
    mi = binned_mi(prod, [f"{a}_x_{b}" for a, b in pairs], "__t", bins=bins)
    names = {f"{a}_x_{b}": (a, b) for a, b in pairs}
    spark = df.sparkSession
    lookup = spark.createDataFrame([(k, a, b) for k, (a, b) in names.items()],
                                   "feature string, feature_1 string, feature_2 string")
    return (mi.join(F.broadcast(lookup), "feature")      # one row per pair
            .orderBy(F.desc("mi"), "feature").limit(max_pairs)
            .select("feature_1", "feature_2", "mi"))


def add_interactions(df: DataFrame, pairs) -> DataFrame:
    """``a_x_b = a * b`` for each chosen pair, as double: products of integers
    never overflow."""
    return df.select("*", *[(qcol(a).cast("double") * qcol(b).cast("double")).alias(f"{a}_x_{b}") for a, b in pairs])


def add_polynomials(df: DataFrame, cols, degree: int = 2) -> DataFrame:
    """``c_powd = c ** d`` for d in 2..degree."""
    def power(c, d):
        # squares as x * x (exactly rounded, as array libraries compute them)
        x = qcol(c).cast("double")
        return x * x if d == 2 else F.pow(x, F.lit(float(d)))
    return df.select("*", *[power(c, d).alias(f"{c}_pow{d}") for c in cols for d in range(2, degree + 1)])


def fit_bins(df: DataFrame, cols, n_bins: int = 5) -> dict[str, list[float]]:
    """G5 fit: equal-width edges from min/max (one aggregation).

    The lowest edge is widened by 0.1% of the range (the usual right-closed
    binning rule); a constant column is widened by 0.1% of |value| on both sides.
    """
    row = df.agg(*[F.min(qcol(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(qcol(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)]).collect()[0]
    out = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            out[c] = []
            continue
        if lo == hi:
            adj = 0.001 * abs(lo) if lo != 0 else 0.001
            lo, hi = lo - adj, hi + adj
            edges = _linspace(lo, hi, n_bins + 1)
        else:
            edges = _linspace(lo, hi, n_bins + 1)
            edges[0] = edges[0] - (hi - lo) * 0.001
        out[c] = edges
    return out


def _linspace(lo: float, hi: float, num: int) -> list[float]:
    """Evenly spaced points as ``k * step + lo`` with the last one exactly ``hi``."""
    step = (hi - lo) / (num - 1)
    pts = [k * step + lo for k in range(num)]
    pts[-1] = hi
    return pts


def apply_bins(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """G5 apply: ``c_binned`` in 0..n-1 (right-closed), NULL outside the fitted range."""
    cols = []
    for c, e in edges.items():
        x = qcol(c).cast("double")
        if not e:
            cols.append(F.lit(None).cast("double").alias(f"{c}_binned"))
            continue
        b = sum((F.when(x > F.lit(edge), 1).otherwise(0) for edge in e[1:-1]), F.lit(0))
        inside = (x > F.lit(e[0])) & (x <= F.lit(e[-1]))
        cols.append(F.when(inside, b.cast("double")).alias(f"{c}_binned"))
    return df.select("*", *cols)


def add_bins(df: DataFrame, cols, n_bins: int = 5) -> DataFrame:
    """G5 on one frame (fit and apply)."""
    return apply_bins(df, fit_bins(df, cols, n_bins))


def add_group_aggregates(df: DataFrame, group_cols, agg_cols) -> DataFrame:
    """Group mean and sd joined back to each row; NULL sd → 0; NULL key → NULL stats.

    Uses a grouped aggregation joined back (map-side partial aggregation), not a
    window: a window would sort every group in one task, and a hot key may hold
    a third of all rows (``apply_group_aggregates`` deals with those).
    """
    out = df
    for g in group_cols:
        stats = fit_group_aggregates(df, g, agg_cols)
        out = apply_group_aggregates(out, g, stats, hot_groups(df, g))
    return out


def fit_group_aggregates(df: DataFrame, group_col: str, agg_cols) -> DataFrame:
    """G7 fit: ``(group, g_col_mean, g_col_std)`` per group on the training frame."""
    aggs = []
    for c in agg_cols:
        aggs += [F.avg(qcol(c).cast("double")).alias(f"{group_col}_{c}_mean"),
                 F.coalesce(F.stddev_samp(qcol(c).cast("double")), F.lit(0.0)).alias(f"{group_col}_{c}_std")]
    return df.where(qcol(group_col).isNotNull()).groupBy(qcol(group_col).alias(group_col)).agg(*aggs)


#: A group of more than this share of the rows is hot; there are at most as many as fit.
HOT_SHARE = 1 / 32


def hot_groups(df: DataFrame, group_col: str, share: float = HOT_SHARE) -> list:
    """The keys of more than ``share`` of all rows, at most ``1 / share`` of them; counted
    from rows that map-side aggregation has already merged."""
    sizes = df.where(qcol(group_col).isNotNull()).groupBy(qcol(group_col).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    rows = sizes.crossJoin(F.broadcast(total)).where(F.col("n") > F.col("total") * share)         # a total of one row
    return [r["k"] for r in rows.select("k").collect()]


def apply_group_aggregates(df: DataFrame, group_col: str, stats: DataFrame, hot: list | None = None) -> DataFrame:
    """G7 apply: each row with its group's statistics; a missing or unseen key gets a NULL
    mean and a zero sd.

    Rows of hot groups (at most ``1 / HOT_SHARE`` keys) meet their few rows of statistics
    by broadcast, where they are; rows without a key meet none; only the others are
    shuffled by key, so no task gets a group of more than ``HOT_SHARE`` of the rows.
    """
    hot = hot_groups(df, group_col) if hot is None else hot
    added = [c for c in stats.columns if c != group_col]
    std_cols = [c for c in added if c.endswith("_std")]
    key = qcol(group_col)
    is_hot = key.isin(hot) if hot else F.lit(False)
    keyless = df.where(key.isNull()).select("*", *[F.lit(None).cast(stats.schema[c].dataType).alias(c) for c in added])
    joined = df.where(key.isNotNull() & ~is_hot).join(stats, on=group_col, how="left").unionByName(keyless)
    if hot:
        few = F.broadcast(stats.where(qcol(group_col).isin(hot)))
        joined = joined.unionByName(df.where(is_hot).join(few, on=group_col, how="left"))
    return joined.select(*[qcol(c) for c in df.columns],
                         *[F.coalesce(qcol(c), F.lit(0.0)).alias(c) if c in std_cols else qcol(c) for c in added])


def run_feature_engineering(df: DataFrame, config: dict, target: str | None = None) -> DataFrame:
    """Interactions → polynomials → bins → group aggregates, by switches."""
    fe = config.get("feature_engineering", {}) or {}
    out = df
    if fe.get("interactions") or fe.get("polynomial") or (fe.get("binning") and not fe.get("bin_numeric_cols")):
        nums = numeric_columns(df, target)
    else:
        nums = []
    if fe.get("interactions"):
        maxp = fe.get("max_interaction_pairs", 20)
        all_pairs = list(combinations(nums, 2))
        if target is not None and len(all_pairs) > maxp:
            pairs = [(r["feature_1"], r["feature_2"]) for r in
                     rank_interaction_pairs(df, nums, target, maxp).collect()]
        else:
            pairs = all_pairs[:maxp]
        out = add_interactions(out, pairs)
    if fe.get("polynomial"):
        out = add_polynomials(out, nums, fe.get("polynomial_degree", 2))
    if fe.get("binning"):
        cols = [c for c in (fe.get("bin_numeric_cols") or nums) if c in out.columns]
        out = add_bins(out, cols, fe.get("n_bins", 5))
    if fe.get("aggregations"):
        groups = [g for g in fe.get("aggregation_groupby", []) if g in out.columns]
        aggs = [a for a in fe.get("aggregation_targets", []) if a in out.columns]
        out = add_group_aggregates(out, groups, aggs)
    return out
