"""Catalog: association statistics (A*) and feature selection (L*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assoc as A
from ..operators import select as L
from .catalog import LINEITEM_NULLS_SQL, MIX_SQL, R, T, lineitem_nulls, mix, r, register
from .q_prep import _binned_mi_sql

NUMS = ["l_quantity", "l_extendedprice", "l_partkey", "l_suppkey"]
NUMS_NULLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax"]
LOG2 = "ln(2.0)"


def _corr_sql(table, cols):
    parts = [f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM {table}"
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    return "\nUNION ALL\n".join(parts)


@register("a1_pearson", f"SELECT feature_1, feature_2, {r('corr')} AS corr FROM ({_corr_sql('lineitem', NUMS)})")
def pearson_q(spark, sf_dir):
    """A1: Pearson correlation of every numeric pair (pairwise complete)."""
    c = A.correlation_pairs(T(spark, sf_dir, "lineitem"), NUMS)
    return c.select("feature_1", "feature_2", R("corr").alias("corr"))


def _rank_table(table, cols):
    sel = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in cols)
    return f"(SELECT {sel} FROM {table})"


@register("a2_spearman", f"SELECT feature_1, feature_2, {r('corr')} AS corr FROM ({_corr_sql(_rank_table('lineitem', NUMS), NUMS)})")
def spearman_q(spark, sf_dir):
    """A2: Spearman correlation (Pearson on tie-averaged ranks)."""
    c = A.correlation_pairs(T(spark, sf_dir, "lineitem"), NUMS, method="spearman")
    return c.select("feature_1", "feature_2", R("corr").alias("corr"))


TAU = [("lineitem", ["l_quantity", "l_discount", "l_tax"]), ("customer", ["c_acctbal", "c_nationkey", "c_custkey"])]


def _kendall_sql(table, a, b):
    """Every cell against every cell: quadratic, which is what the operator must equal."""
    return f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2, s / 2 / (sqrt(n0 - n1) * sqrt(n0 - n2)) AS corr FROM (
WITH c AS (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y, count(*) AS n FROM {table}
           WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)
SELECT (SELECT sum(CAST(l.n * r.n * sign(l.x - r.x) * sign(l.y - r.y) AS DOUBLE)) FROM c l, c r) AS s,
       (SELECT CAST(sum(n) * (sum(n) - 1) / 2 AS DOUBLE) FROM c) AS n0,
       (SELECT CAST(sum(t * (t - 1) / 2) AS DOUBLE) FROM (SELECT sum(n) AS t FROM c GROUP BY x)) AS n1,
       (SELECT CAST(sum(t * (t - 1) / 2) AS DOUBLE) FROM (SELECT sum(n) AS t FROM c GROUP BY y)) AS n2)"""


@register("a2_kendall", f"SELECT feature_1, feature_2, {r('corr')} AS corr FROM (" + "\nUNION ALL\n".join(
    _kendall_sql(t, a, b) for t, cols in TAU for i, a in enumerate(cols) for b in cols[i + 1:]) + ")")
def kendall_q(spark, sf_dir):
    """A2: Kendall's tau-b, columns with many ties (lineitem) and with few (customer)."""
    out = None
    for table, cols in TAU:
        c = A.correlation_pairs(T(spark, sf_dir, table), cols, method="kendall")
        out = c if out is None else out.unionByName(c)
    return out.select("feature_1", "feature_2", R("corr").alias("corr"))


@register("a1_masked_correlation", f"SELECT feature_1, feature_2, {r('corr', 6)} AS corr FROM ({_corr_sql(LINEITEM_NULLS_SQL, NUMS_NULLS)})")
def masked_correlation_q(spark, sf_dir):
    """Pairwise-complete correlations with NULLs from one scan of masked Gram products."""
    li = lineitem_nulls(spark, sf_dir)
    pairs = [(a, b) for i, a in enumerate(NUMS_NULLS) for b in NUMS_NULLS[i + 1:]]
    c = A._correlation_pairs_wide(li, NUMS_NULLS, pairs)
    return c.select("feature_1", "feature_2", R("corr", 6).alias("corr"))


@register("a3_contingency", "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem "
                            "WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2")
def contingency_q(spark, sf_dir):
    """A3: contingency table in long form."""
    return A.contingency(T(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@register("a4_row_normalised", f"""SELECT l_linenumber, l_returnflag, count(*) AS count,
  {r('count(*) / sum(count(*)) OVER (PARTITION BY l_linenumber)')} AS share
FROM lineitem WHERE l_linenumber IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2""")
def row_norm_q(spark, sf_dir):
    """A4: contingency table normalised by row."""
    c = A.contingency(T(spark, sf_dir, "lineitem"), "l_linenumber", "l_returnflag", normalize="index")
    return c.select("l_linenumber", "l_returnflag", "count", R("share").alias("share"))


def _cells_sql(table, cols, diagonal=True):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i if diagonal else i + 1:]:
            parts.append(f"SELECT '{a}' AS f1, '{b}' AS f2, CAST({a} AS VARCHAR) AS v1, CAST({b} AS VARCHAR) AS v2 "
                         f"FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return f"(SELECT f1, f2, v1, v2, count(*) AS cnt FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)"


def _margins_sql(cells):
    return f"""(SELECT *, sum(cnt) OVER (PARTITION BY f1, f2) AS n, sum(cnt) OVER (PARTITION BY f1, f2, v1) AS n1,
  sum(cnt) OVER (PARTITION BY f1, f2, v2) AS n2 FROM {cells})"""


def _cramers_sql(table, cols):
    chi = f"""(SELECT f1, f2, max(n) AS n, count(DISTINCT v1) AS r, count(DISTINCT v2) AS k,
       max(n) * (sum(cnt * cnt / (n1 * n2)) - 1.0) AS chi2 FROM {_margins_sql(_cells_sql(table, cols))} GROUP BY f1, f2)"""
    return f"""(SELECT f1, f2, CAST(n AS BIGINT) AS n, CAST(r AS BIGINT) AS r, CAST(k AS BIGINT) AS k, chi2,
  CASE WHEN n > 1 AND least((k - (k - 1) * (k - 1) / (n - 1.0)) - 1, (r - (r - 1) * (r - 1) / (n - 1.0)) - 1) > 0
       THEN sqrt(greatest(0.0, chi2 / n - (k - 1) * (r - 1) / (n - 1.0))
                 / least((k - (k - 1) * (k - 1) / (n - 1.0)) - 1, (r - (r - 1) * (r - 1) / (n - 1.0)) - 1)) END AS cramers_v
FROM {chi})"""


@register("a5_a7_cramers_v", f"SELECT f1, f2, n, r, k, {r('chi2', 6)} AS chi2, {r('cramers_v')} AS cramers_v FROM {_cramers_sql('lineitem', CATS)}")
def cramers_q(spark, sf_dir):
    """Chi-square and bias-corrected Cramér's V for every categorical pair (one aggregation)."""
    v = A.cramers_v_pairs(A.pair_cells(T(spark, sf_dir, "lineitem"), CATS))
    return v.select("f1", "f2", "n", "r", "k", R("chi2", 6).alias("chi2"), R("cramers_v").alias("cramers_v"))


def _theil_sql(table, cols):
    cells = _cells_sql(table, cols)
    both = f"(SELECT f1, f2, v1, v2, cnt FROM {cells} UNION ALL SELECT f2, f1, v2, v1, cnt FROM {cells} WHERE f1 <> f2)"
    m = _margins_sql(both)
    return f"""(WITH m AS {m},
c AS (SELECT f1, f2, -sum(cnt / n * (ln(cnt / n2 + 1e-9) / {LOG2})) AS hxy FROM m GROUP BY 1, 2),
h AS (SELECT f1, f2, -sum(n1 / n * (ln(n1 / n + 1e-9) / {LOG2})) AS hx FROM (SELECT DISTINCT f1, f2, v1, n1, n FROM m) GROUP BY 1, 2)
SELECT f1 AS feature_1, f2 AS feature_2, hx AS h_x, hxy AS h_x_given_y,
  CASE WHEN hx <> 0 THEN (hx - hxy) / hx END AS theils_u FROM c JOIN h USING (f1, f2))"""


@register("a8_a10_theils_u", f"SELECT feature_1, feature_2, {r('h_x')} AS h_x, {r('h_x_given_y')} AS h_x_given_y, "
                             f"{r('theils_u')} AS theils_u FROM {_theil_sql('lineitem', CATS)}")
def theils_q(spark, sf_dir):
    """Entropy, conditional entropy and Theil's U, both directions of every pair."""
    u = A.theils_u_pairs(A.pair_cells(T(spark, sf_dir, "lineitem"), CATS))
    return u.select("feature_1", "feature_2", R("h_x").alias("h_x"), R("h_x_given_y").alias("h_x_given_y"),
                    R("theils_u").alias("theils_u"))


def _anova_sql(table, nums, cats):
    parts = [f"SELECT '{c}' AS categorical, '{x}' AS feature, CAST({c} AS VARCHAR) AS level, CAST({x} AS DOUBLE) AS x "
             f"FROM {table} WHERE {c} IS NOT NULL AND {x} IS NOT NULL" for c in cats for x in nums]
    return f"""(WITH g AS (SELECT categorical, feature, level, count(*) AS n, avg(x) AS m, var_pop(x) AS v
           FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2, 3),
t AS (SELECT categorical, feature, sum(n) AS nn, count(*) AS gg, sum(n * m) / sum(n) AS grand FROM g GROUP BY 1, 2),
s AS (SELECT categorical, feature, nn, gg, sum(n * (m - grand) * (m - grand)) AS ssb, sum(n * v) AS ssw
      FROM g JOIN t USING (categorical, feature) GROUP BY 1, 2, 3, 4)
SELECT categorical, feature, CASE WHEN gg >= 2 AND nn > gg AND ssw <> 0 THEN (ssb / (gg - 1)) / (ssw / (nn - gg)) END AS f_stat FROM s)"""


AN_NUMS = ["l_quantity", "l_extendedprice"]
AN_CATS = ["l_returnflag", "l_linestatus", "l_linenumber"]


@register("a11_anova", f"SELECT categorical, feature, {r('f_stat', 6)} AS f_stat FROM {_anova_sql('lineitem', AN_NUMS, AN_CATS)}")
def anova_q(spark, sf_dir):
    """One-way ANOVA F of each numeric column across categorical levels."""
    a = A.anova_f(T(spark, sf_dir, "lineitem"), AN_NUMS, AN_CATS)
    return a.select("categorical", "feature", R("f_stat", 6).alias("f_stat"))


def _mi_pairs_sql(table, nums, cats, bins=32):
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    parts = []
    for c in cats:
        for x in nums:
            parts.append(f"""SELECT '{c}' AS f1, '{x}' AS f2, CAST({c} AS VARCHAR) AS v1,
  CAST(len(list_filter(ed.e, lambda q: CAST({x} AS DOUBLE) > q)) AS VARCHAR) AS v2
FROM {table}, (SELECT quantile_cont(CAST({x} AS DOUBLE), [{probs}]) AS e FROM {table}) ed
WHERE {c} IS NOT NULL AND {x} IS NOT NULL""")
    cells = f"(SELECT f1, f2, v1, v2, count(*) AS cnt FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)"
    return f"""(SELECT f1 AS categorical, f2 AS feature, greatest(sum(cnt / n * ln(cnt * n / (n1 * n2))), 0.0) AS mi
FROM {_margins_sql(cells)} GROUP BY 1, 2)"""


MI_NUMS = ["l_quantity", "l_extendedprice"]
MI_CATS = ["l_returnflag", "l_linestatus"]


@register("a12_mutual_information", f"SELECT categorical, feature, {r('mi')} AS mi FROM {_mi_pairs_sql('lineitem', MI_NUMS, MI_CATS)}")
def mi_q(spark, sf_dir):
    """MI (nats) between 32-quantile bins of numeric columns and categorical columns."""
    m = A.mutual_information(T(spark, sf_dir, "lineitem"), MI_NUMS, MI_CATS)
    return m.select("categorical", "feature", R("mi").alias("mi"))


RED_NUMS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "disc_price"]
RED_CATS = ["l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
RED_SQL = "(SELECT *, l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem)"


def red_frame(spark, sf_dir):
    """lineitem plus the derived discounted price (strongly tied to the price)."""
    li = T(spark, sf_dir, "lineitem")
    return li.withColumn("disc_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


def _redundant_sql(table, nums, cats):
    corr = _corr_sql(table, nums)
    cv = _cramers_sql(table, cats)
    return f"""
SELECT feature_1, feature_2, 'corr' AS metric, {r('corr')} AS value
FROM (SELECT feature_1, feature_2, corr FROM ({corr}) UNION ALL SELECT feature_2, feature_1, corr FROM ({corr}))
WHERE feature_1 < feature_2 AND abs(corr) > 0.85
UNION ALL
SELECT f1, f2, 'cramers_v', {r('cramers_v')}
FROM (SELECT f1, f2, cramers_v FROM {cv} UNION ALL SELECT f2, f1, cramers_v FROM {cv} WHERE f1 <> f2)
WHERE f1 < f2 AND cramers_v > 0.8
UNION ALL
SELECT feature, categorical, 'mutual_info', {r('mi')} FROM {_mi_pairs_sql(table, nums, cats)} WHERE mi > 0.5
UNION ALL
SELECT feature, categorical, 'anova_f', {r('f_stat', 6)} FROM {_anova_sql(table, nums, cats)} WHERE f_stat > 50.0"""


def _round_redundant(df):
    return df.select("feature_1", "feature_2", "metric",
                     F.when(F.col("metric") == "anova_f", R("value", 6)).otherwise(R("value")).alias("value"))


@register("a13_redundant_pairs", _redundant_sql(RED_SQL, RED_NUMS, RED_CATS))
def redundant_q(spark, sf_dir):
    """Pairs over any redundancy threshold (|corr| > .85, V > .8, MI > .5, F > 50)."""
    li = red_frame(spark, sf_dir)
    levels = A.coded_levels(li, RED_CATS)
    corr = A.correlation_matrix(li, RED_NUMS)
    cv = A.cramers_v_matrix(li, RED_CATS, levels)
    mi = A.mutual_information(li, RED_NUMS, RED_CATS, levels=levels)
    an = A.anova_f(li, RED_NUMS, RED_CATS, levels)
    return _round_redundant(A.redundant_features(corr, cv, mi, an, spark))


@register("a14_feature_feature", _redundant_sql(RED_SQL, RED_NUMS, RED_CATS))
def feature_feature_q(spark, sf_dir):
    """The whole feature–feature analysis of lineitem plus the discounted
    price (typing and cleaning from the profile), reported as its redundancy table."""
    res = A.analyze_feature_feature(red_frame(spark, sf_dir))
    return _round_redundant(res["redundant_features"])


FT_NUMS, FT_CATS = ["l_orderkey", "l_quantity", "l_extendedprice"], ["l_linenumber", "l_discount", "l_tax", "l_linestatus"]


def _feature_target_sql():
    null = "CAST(NULL AS VARCHAR)"
    parts = []
    for c in FT_NUMS:
        for stat, e in (("slope", f"regr_slope(y, {c})"), ("intercept", f"regr_intercept(y, {c})"), ("r2", f"regr_r2(y, {c})"),
                        ("n", f"regr_count(y, {c})")):
            parts.append(f"SELECT '{c}' AS feature, 'numeric_vs_numeric' AS analysis, {null} AS level, {null} AS class, "
                         f"'{stat}' AS statistic, CAST({e} AS DOUBLE) AS value FROM t")
        box = f"""SELECT l_returnflag AS class, count(*) AS n, max(q[1]) AS q1, max(q[2]) AS median, max(q[3]) AS q3,
  min(CASE WHEN {c} BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1]) THEN {c} END) AS whisker_low,
  max(CASE WHEN {c} BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1]) THEN {c} END) AS whisker_high,
  count_if(NOT {c} BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1])) AS n_outliers
FROM t JOIN (SELECT l_returnflag, quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM t GROUP BY 1) USING (l_returnflag) GROUP BY 1"""
        for stat in ("n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers"):
            parts.append(f"SELECT '{c}', 'numeric_vs_categorical', {null}, class, '{stat}', CAST({stat} AS DOUBLE) FROM ({box})")
    for c in FT_CATS:
        for stat, e in (("target_mean", "avg(y)"), ("target_sd", "stddev_samp(y)"), ("n", "count(*)")):
            parts.append(f"SELECT '{c}', 'categorical_vs_numeric', CAST({c} AS VARCHAR), {null}, '{stat}', CAST({e} AS DOUBLE) FROM t GROUP BY {c}")
        cells = f"SELECT CAST({c} AS VARCHAR) AS level, l_returnflag AS class, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY {c}) AS share FROM t GROUP BY {c}, l_returnflag"
        for stat in ("count", "share"):
            parts.append(f"SELECT '{c}', 'categorical_vs_categorical', level, class, '{stat}', CAST({stat} AS DOUBLE) FROM ({cells})")
    body = "\nUNION ALL\n".join(parts)
    return (f"WITH t AS (SELECT *, CAST(l_returnflag = 'R' AS DOUBLE) AS y FROM lineitem) "
            f"SELECT feature, analysis, level, class, statistic, {r('value', 6)} AS value FROM ({body})")


@register("a15_feature_target", _feature_target_sql())
def feature_target_q(spark, sf_dir):
    """Every statistic of the lineitem features against a numeric target (the text
    '0' or '1', which P10 turns to numbers) and against a categorical one."""
    li = T(spark, sf_dir, "lineitem").select(*FT_NUMS, *FT_CATS, "l_returnflag")
    number = li.withColumn("y", (F.col("l_returnflag") == "R").cast("int").cast("string")).drop("l_returnflag")
    res = A.analyze_feature_target(number, "y").unionByName(A.analyze_feature_target(li, "l_returnflag"))
    return res.withColumn("value", R("value", 6))


@register("a16_regression_line", "\nUNION ALL\n".join(
    f"SELECT '{x}' AS feature, {r(f'regr_slope(l_extendedprice, {x})', 6)} AS slope, "
    f"{r(f'regr_intercept(l_extendedprice, {x})', 6)} AS intercept, {r(f'regr_r2(l_extendedprice, {x})')} AS r2, "
    f"CAST(regr_count(l_extendedprice, {x}) AS BIGINT) AS n FROM lineitem" for x in ["l_quantity", "l_discount"]))
def regression_line_q(spark, sf_dir):
    """Least-squares line of the target on each numeric feature."""
    n = A.numeric_vs_numeric(T(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")
    return n.select("feature", R("slope", 6).alias("slope"), R("intercept", 6).alias("intercept"),
                    R("r2").alias("r2"), F.col("n").cast("long").alias("n"))


@register("a17_target_by_level", f"""SELECT l_linestatus, {r('avg(CAST(is_returned AS DOUBLE))')} AS target_mean,
  {r('stddev_samp(CAST(is_returned AS DOUBLE))')} AS target_sd, count(*) AS n
FROM {MIX_SQL} WHERE l_linestatus IS NOT NULL AND is_returned IS NOT NULL GROUP BY 1""")
def target_by_level_q(spark, sf_dir):
    """Mean, sd and count of a binary target per category level."""
    t = A.categorical_vs_target(mix(spark, sf_dir), "l_linestatus", "is_returned")
    return t.select("l_linestatus", R("target_mean").alias("target_mean"), R("target_sd").alias("target_sd"), "n")


def _box_by_sql():
    from .q_profile import _box_sql
    return _box_sql("lineitem", "l_extendedprice", "l_returnflag")


@register("a18_box_by_class", _box_by_sql())
def box_by_class_q(spark, sf_dir):
    """Box statistics of a numeric feature per target class."""
    b = A.numeric_vs_categorical(T(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag")
    return b.select("l_returnflag", "n", R("q1").alias("q1"), R("median").alias("median"), R("q3").alias("q3"),
                    "whisker_low", "whisker_high", "n_outliers")


# --------------------------------------------------------------------------
# L: selection
# --------------------------------------------------------------------------

L1_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_linestatus"]


def _l1_sql():
    probs = ", ".join(str(i / 32) for i in range(1, 32))
    parts = []
    for c in L1_FEATURES:
        if c == "l_linestatus":
            parts.append(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, CAST(is_returned AS VARCHAR) AS y "
                         f"FROM {MIX_SQL} WHERE {c} IS NOT NULL AND is_returned IS NOT NULL")
        else:
            parts.append(f"""SELECT '{c}' AS feature, CAST(len(list_filter(ed.e, lambda q: CAST({c} AS DOUBLE) > q)) AS VARCHAR) AS v,
  CAST(is_returned AS VARCHAR) AS y FROM {MIX_SQL},
  (SELECT quantile_cont(CAST({c} AS DOUBLE), [{probs}]) AS e FROM {MIX_SQL}) ed WHERE {c} IS NOT NULL AND is_returned IS NOT NULL""")
    cells = f"(SELECT feature, v, y, count(*) AS cnt FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)"
    return f"""WITH m AS (SELECT *, sum(cnt) OVER (PARTITION BY feature) AS n, sum(cnt) OVER (PARTITION BY feature, v) AS nv,
  sum(cnt) OVER (PARTITION BY feature, y) AS ny FROM {cells}),
s AS (SELECT feature, greatest(sum(cnt / n * ln(cnt * n / (nv * ny))), 0.0) AS mi FROM m GROUP BY 1)"""


@register("l1_mi_filter", _l1_sql() + f"""
SELECT feature, {r('mi')} AS mi, row_number() OVER (ORDER BY mi DESC, feature) <= {len(L1_FEATURES) // 2} AS selected FROM s""")
def mi_filter_q(spark, sf_dir):
    """L1: MI of each feature with the target; the top 50% are kept."""
    selected, scores = L.mutual_info_filter(mix(spark, sf_dir), L1_FEATURES, "is_returned", "classification", 50)
    return scores.select("feature", R("mi").alias("mi"), F.col("feature").isin(selected).alias("selected"))


L2_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
L2_COEFS = [0.5, -0.001, 20.0, 10.0, 0.1]


def _l2_sql():
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, avg(abs({w} * (CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM lineitem)))) AS score FROM lineitem"
        for c, w in zip(L2_FEATURES, L2_COEFS))


@register("l2_linear_attribution", f"SELECT feature, {r('score')} AS score FROM ({_l2_sql()})")
def attribution_q(spark, sf_dir):
    """L2: exact mean |attribution| of a linear model with fixed coefficients."""
    s = L.linear_attribution(T(spark, sf_dir, "lineitem"), L2_FEATURES, L2_COEFS)
    return s.select("feature", R("score").alias("score"))


@register("l5_intersection", _l1_sql().replace("WITH m AS", "WITH m AS", 1) + f""",
a AS (SELECT feature, score, row_number() OVER (ORDER BY score DESC, feature) AS rank FROM ({_l2_sql()})),
sel_mi AS (SELECT feature FROM (SELECT feature, row_number() OVER (ORDER BY mi DESC, feature) AS rk FROM s) WHERE rk <= {len(L1_FEATURES) // 2})
SELECT feature, CAST(rank AS INTEGER) AS rank FROM a WHERE rank <= {int(len(L2_FEATURES) * 0.8)} AND feature IN (SELECT feature FROM sel_mi)""")
def intersection_q(spark, sf_dir):
    """Features kept by both the MI filter (top 50%) and the attribution filter (top 80%)."""
    mi_sel, _ = L.mutual_info_filter(mix(spark, sf_dir), L1_FEATURES, "is_returned", "classification", 50)
    scores = L.linear_attribution(T(spark, sf_dir, "lineitem"), L2_FEATURES, L2_COEFS)
    attr_sel, _ = L.attribution_filter(scores, len(L2_FEATURES), 80)
    final = L.intersect_selection(None, attr_sel, mi_sel)
    return spark.createDataFrame([(f, attr_sel.index(f) + 1) for f in final], "feature string, rank int")
