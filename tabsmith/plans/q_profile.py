"""Catalog: profiling and typing (B*), row preparation (P*), splits (X*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import split as X
from .catalog import (DOCS_SQL, LINEITEM_NULLS_SQL, MIX_COLS, MIX_SQL, R, T, docs_labels, lineitem_nulls,
                      mix, r, register)

MIX_KINDS = {"l_orderkey": "numeric", "l_partkey": "numeric", "l_suppkey": "numeric", "l_linenumber": "numeric",
             "l_quantity": "numeric", "l_extendedprice": "numeric", "l_discount": "numeric", "l_tax": "numeric",
             "l_linestatus": "string", "l_shipdate": "datetime"}


def _profile_sql(table: str, cols: list[tuple[str, str]], target: str | None) -> str:
    """DuckDB twin of ``profile`` + ``feature_type_expr`` (one SELECT per column)."""
    parts = []
    for pos, (c, kind) in enumerate(cols):
        num = kind == "numeric"
        x = f"CAST({c} AS DOUBLE)"
        stats = (f"count(*) AS n_rows, count({c}) AS n_nonnull, "
                 + (f"min({x}) AS mn, max({x}) AS mx, avg({x}) AS av, stddev_samp({x}) AS sd, "
                    f"CAST(count_if({x} = 0) AS BIGINT) AS zc" if num else
                    "CAST(NULL AS DOUBLE) AS mn, CAST(NULL AS DOUBLE) AS mx, CAST(NULL AS DOUBLE) AS av, "
                    "CAST(NULL AS DOUBLE) AS sd, CAST(NULL AS BIGINT) AS zc"))
        vc = f"(SELECT CAST({c} AS VARCHAR) AS v, {x if num else 'NULL'} AS num, count(*) AS cnt" + \
             (f", avg(CAST({target} AS DOUBLE)) AS tm" if target else "") + \
             f" FROM {table} WHERE {c} IS NOT NULL GROUP BY 1, 2)"
        if target and num:
            ordinal = (f"(SELECT coalesce(count(*) >= 3 AND (bool_and(tm >= ptm OR ptm IS NULL) "
                       f"OR bool_and(tm <= ptm OR ptm IS NULL)), false) "
                       f"FROM (SELECT tm, lag(tm) OVER (ORDER BY num) AS ptm FROM {vc}))")
        else:
            ordinal = "false"
        parts.append(f"""SELECT {pos} AS position, '{c}' AS column_name, w.n_rows, w.n_nonnull,
  w.n_rows - w.n_nonnull AS n_null, u.n_unique, u.top_value, u.top_count,
  {r('(w.n_rows - w.n_nonnull) / w.n_rows')} AS missing_ratio,
  w.mn AS min, w.mx AS max, {r('w.av')} AS mean, {r('w.sd')} AS sd, w.zc AS zero_count,
  CASE WHEN u.n_unique <= 20 THEN {ordinal} ELSE false END AS is_ordinal,
  '{kind}' AS kind
FROM (SELECT {stats} FROM {table}) w,
     (SELECT count(*) AS n_unique, coalesce(max(cnt), 0) AS top_count,
             (SELECT v FROM {vc} ORDER BY cnt DESC, v LIMIT 1) AS top_value FROM {vc}) u""")
    body = "\nUNION ALL\n".join(parts)
    ftype = """CASE WHEN kind = 'datetime' THEN 'datetime'
  WHEN kind = 'numeric' AND n_unique = 2 THEN 'binary'
  WHEN kind = 'numeric' AND n_unique <= 20 AND is_ordinal THEN 'ordinal'
  WHEN kind = 'numeric' AND n_unique <= 20 THEN 'categorical'
  WHEN kind = 'numeric' THEN 'numeric'
  WHEN n_unique <= 20 THEN 'categorical' ELSE 'high_cardinality' END"""
    return (f"SELECT position, column_name, n_rows, n_nonnull, n_null, n_unique, top_value, top_count, "
            f"missing_ratio, min, max, mean, sd, zero_count, is_ordinal, {ftype} AS feature_type FROM ({body})")


def feature_types_mix(spark, sf_dir):
    """B1 + B12 + B13 on D-MIX (target ``is_returned``): one row per column."""
    t = P.detect_feature_types(mix(spark, sf_dir), target="is_returned")
    return t.select("position", "column_name", "n_rows", "n_nonnull", "n_null", "n_unique", "top_value",
                    "top_count", R("missing_ratio").alias("missing_ratio"), "min", "max",
                    R("mean").alias("mean"), R("sd").alias("sd"), "zero_count", "is_ordinal", "feature_type")


register("b13_feature_types", _profile_sql(MIX_SQL, [(c, MIX_KINDS[c]) for c in MIX_COLS], "is_returned"),
         headline=True)(feature_types_mix)


@register("b13_typed_columns", f"""SELECT position, column_name, n_rows, n_nonnull, n_null, missing_ratio, min, max, mean, sd, zero_count,
  is_ordinal, feature_type, CASE WHEN n_unique <= 900 THEN n_unique END AS n_unique,
  CASE WHEN n_unique <= 900 OR top_count * 2 > n_nonnull THEN top_value END AS top_value,
  CASE WHEN n_unique <= 900 OR top_count * 2 > n_nonnull THEN top_count END AS top_count
FROM ({_profile_sql(MIX_SQL, [(c, MIX_KINDS[c]) for c in MIX_COLS], "is_returned")})""")
def typed_columns_q(spark, sf_dir):
    """B1-B13 on D-MIX without a row per distinct value: typing from the bounded profile, with the
    exact counts of all columns whose values are surely counted one by one."""
    t = P.bounded_profile(mix(spark, sf_dir), target="is_returned").withColumn("feature_type", P.feature_type_expr())
    few = F.col("n_unique") <= 900          # counted one by one, whatever the estimate's error
    known = few | (F.col("top_count") * 2 > F.col("n_nonnull"))
    return t.select(
        "position", "column_name", "n_rows", "n_nonnull", "n_null", R("missing_ratio").alias("missing_ratio"), "min", "max",
        R("mean").alias("mean"), R("sd").alias("sd"), "zero_count", "is_ordinal", "feature_type",
        F.when(few, F.col("n_unique")).alias("n_unique"), F.when(known, F.col("top_value")).alias("top_value"),
        F.when(known, F.col("top_count")).alias("top_count"))


@register("b5_datetime_parse", """
SELECT column_name, n_nonnull, CAST(n_parsed AS BIGINT) AS n_parsed, {rate} AS parse_rate, n_parsed >= 0.8 * n_nonnull AND n_nonnull > 0 AS is_datetime
FROM (
  SELECT 'props' AS column_name, count(props) AS n_nonnull,
         count_if(try_cast(trim(props) AS TIMESTAMP) IS NOT NULL
                  AND NOT regexp_full_match(trim(props), '[+-]?[0-9]+(\\.[0-9]*)?')) AS n_parsed FROM events
  UNION ALL
  SELECT 'ts_text', count(ts), count_if(try_cast(trim(CAST(ts AS VARCHAR)) AS TIMESTAMP) IS NOT NULL) FROM events
  UNION ALL
  SELECT 'event_type', count(event_type), count_if(try_cast(trim(event_type) AS TIMESTAMP) IS NOT NULL) FROM events)
""".format(rate=r("n_parsed / n_nonnull")))
def datetime_parse(spark, sf_dir):
    """Share of non-NULL strings that parse as timestamps (digit-only strings excluded)."""
    ev = T(spark, sf_dir, "events").select("props", F.col("ts").cast("string").alias("ts_text"), "event_type")
    w = P.wide_stats(ev)
    return w.select("column_name", "n_nonnull", F.col("n_parsed_datetime").alias("n_parsed"),
                    R(F.col("n_parsed_datetime") / F.col("n_nonnull")).alias("parse_rate"),
                    ((F.col("n_parsed_datetime") >= 0.8 * F.col("n_nonnull")) & (F.col("n_nonnull") > 0)).alias("is_datetime"))


@register("b14_eda_types", """
SELECT column_name, CASE WHEN kind = 'numeric' AND n_unique > 20 THEN 'numeric' ELSE 'categorical' END AS eda_type
FROM ({inner})""".format(inner=_profile_sql("lineitem", [(c, MIX_KINDS.get(c, "string")) for c in
                                                          ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount",
                                                           "l_tax", "l_linenumber", "l_returnflag", "l_linestatus"]],
                                             None).replace("SELECT position, column_name,", "SELECT position, column_name, kind,", 1)))
def eda_types_q(spark, sf_dir):
    """EDA split — numeric with <= 20 values counts as categorical."""
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                             "l_linenumber", "l_returnflag", "l_linestatus")
    return P.eda_types(P.bounded_profile(li)).select("column_name", "eda_type")


@register("b15_stable_categoricals", """
WITH p AS ({inner})
SELECT column_name FROM p
WHERE (kind = 'string' OR (kind = 'numeric' AND n_unique <= 20))
  AND n_nonnull > 0 AND n_unique <= 50 AND n_null / n_rows <= 0.5 AND top_count / n_nonnull <= 0.99
""".format(inner=_profile_sql(LINEITEM_NULLS_SQL, [("l_linenumber", "numeric"), ("l_quantity", "numeric"),
                                                   ("l_extendedprice", "numeric"), ("l_discount", "numeric"),
                                                   ("l_linestatus", "string"), ("l_returnflag", "string"),
                                                   ("l_tax", "numeric")], None)
           .replace("SELECT position, column_name,", "SELECT position, column_name, kind,", 1)))
def stable_cats(spark, sf_dir):
    """Categoricals kept for association statistics (<= 50 values, <= 50% missing, top share <= 0.99)."""
    df = lineitem_nulls(spark, sf_dir).select("l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                              "l_linestatus", "l_returnflag", "l_tax")
    return P.stable_categoricals(P.bounded_profile(df)).select("column_name")


@register("b16_problem_type", """
SELECT 'o_totalprice' AS target, count(DISTINCT o_totalprice) AS n_unique, 'regression' AS problem_type, 'regression' AS trainer_task FROM orders
UNION ALL
SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), 'classification', 'regression' FROM orders
UNION ALL
SELECT 'is_returned', count(DISTINCT is_returned),
  CASE WHEN count(DISTINCT is_returned) <= 20 THEN 'classification' ELSE 'regression' END,
  CASE WHEN count(DISTINCT is_returned) <= 20 THEN 'classification' ELSE 'regression' END FROM {mix}
""".format(mix=MIX_SQL))
def problem_type_q(spark, sf_dir):
    """Problem type by the EDA rule and by the trainer rule, for three targets."""
    o = T(spark, sf_dir, "orders")
    m = mix(spark, sf_dir)
    return (P.problem_type(o, "o_totalprice").unionByName(P.problem_type(o, "o_orderstatus"))
            .unionByName(P.problem_type(m, "is_returned")))


ORDER_NUM = ["o_orderkey", "o_custkey", "o_totalprice"]


@register("b18_describe", "\nUNION ALL\n".join(
    [f"""SELECT '{c}' AS column_name, count({c}) AS count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top,
  CAST(NULL AS BIGINT) AS freq, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, CAST(min({c}) AS DOUBLE) AS min,
  {r(f'quantile_cont({c}, 0.25)')} AS p25, {r(f'quantile_cont({c}, 0.5)')} AS p50, {r(f'quantile_cont({c}, 0.75)')} AS p75,
  CAST(max({c}) AS DOUBLE) AS max FROM orders""" for c in ORDER_NUM] +
    [f"""SELECT '{c}', count({c}), (SELECT count(DISTINCT {c}) FROM orders),
  (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1),
  (SELECT max(n) FROM (SELECT count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY {c})),
  NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders""" for c in ["o_orderstatus", "o_orderpriority"]]))
def describe_q(spark, sf_dir):
    """describe(include='all') in long form."""
    o = T(spark, sf_dir, "orders").select(*ORDER_NUM, "o_orderstatus", "o_orderpriority")
    d = P.describe(o)
    return d.select("column_name", "count", "unique", "top", "freq", R("mean").alias("mean"), R("std").alias("std"),
                    "min", R("p25").alias("p25"), R("p50").alias("p50"), R("p75").alias("p75"), "max")


DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@register("b19_info", "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS n_nonnull FROM {DOCS_SQL}" for i, c in enumerate(DOC_COLS)))
def info_q(spark, sf_dir):
    """Non-NULL count per column of D-NULL."""
    return P.info(docs_labels(spark, sf_dir).select(*DOC_COLS)).select("position", "column_name", "n_nonnull")


@register("b20_missing_counts", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM {DOCS_SQL}" for c in DOC_COLS)
    + ") WHERE missing_count > 0")
def missing_q(spark, sf_dir):
    """Columns with missing values and their counts."""
    return P.missing_counts(docs_labels(spark, sf_dir).select(*DOC_COLS))


LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("b21_zeroness", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} = 0) AS BIGINT) AS zero_count, {r(f'count_if({c} = 0) / count(*)')} AS zero_pct, "
    f"count_if({c} = 0) / count(*) > 0.5 AS zero_heavy FROM lineitem" for c in LI_NUM))
def zeroness_q(spark, sf_dir):
    """Zero counts and shares of all rows per numeric column."""
    z = P.zeroness(T(spark, sf_dir, "lineitem"))
    return z.select("column_name", "zero_count", R("zero_pct").alias("zero_pct"), "zero_heavy")


@register("b22_value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def value_counts_q(spark, sf_dir):
    """Value counts of one column."""
    return P.value_counts(T(spark, sf_dir, "orders"), "o_orderpriority")


@register("b23_value_shares", f"""SELECT c_mktsegment, count(*) AS count,
  {r('count(*) / (SELECT count(c_mktsegment) FROM customer)')} AS share
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1""")
def value_shares_q(spark, sf_dir):
    """Value shares of non-NULL rows."""
    v = P.value_counts(T(spark, sf_dir, "customer"), "c_mktsegment", normalize=True)
    return v.select("c_mktsegment", "count", R("share").alias("share"))


@register("b24_top_n", f"""
WITH vc AS (SELECT p_name, count(*) AS count FROM part WHERE p_name IS NOT NULL GROUP BY 1),
top AS (SELECT * FROM vc ORDER BY count DESC, p_name LIMIT 20),
rare AS (SELECT CAST((SELECT count(p_name) FROM part) - (SELECT sum(count) FROM top) AS BIGINT) AS rare_rows)
SELECT top.p_name, top.count, rare.rare_rows,
  {r('100.0 * rare.rare_rows / (SELECT count(p_name) FROM part)')} AS rare_pct FROM top, rare""")
def top_n_q(spark, sf_dir):
    """Top-20 values and the share of rows outside them."""
    top, rare = P.top_n_summary(T(spark, sf_dir, "part"), "p_name", 20)
    return top.crossJoin(rare.select(F.col("rare_rows").cast("long").alias("rare_rows"),
                                     R("rare_pct").alias("rare_pct")))


@register("b25_histogram", f"""
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END AS wd FROM mm),
b AS (SELECT least(floor((l_extendedprice - lo) / wd) + 1, 30) AS bin, count(*) AS count
      FROM lineitem, w WHERE l_extendedprice IS NOT NULL GROUP BY 1),
g AS (SELECT range + 1 AS bin FROM range(30))
SELECT CAST(g.bin AS INTEGER) AS bin, {r('lo + (g.bin - 1) * wd')} AS lower, {r('lo + g.bin * wd')} AS upper,
  coalesce(b.count, 0) AS count FROM g CROSS JOIN w LEFT JOIN b ON b.bin = g.bin""")
def histogram_q(spark, sf_dir):
    """30 equal-width bins; the maximum falls in the last bin."""
    h = P.histogram(T(spark, sf_dir, "lineitem"), "l_extendedprice", 30)
    return h.select("bin", R("lower").alias("lower"), R("upper").alias("upper"), "count")


@register("b26_density", f"""
WITH st AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(o_totalprice) AS n,
                   stddev_samp(o_totalprice) AS sd FROM orders),
s2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw,
              CASE WHEN hi > lo THEN (hi - lo) / 1000 ELSE 1.0 END AS w FROM st),
c AS (SELECT least(floor((o_totalprice - lo) / w), 999) AS k, count(*) AS cnt FROM orders, s2
      WHERE o_totalprice IS NOT NULL GROUP BY 1),
g AS (SELECT range AS g FROM range(200)),
gx AS (SELECT g, lo + (hi - lo) * g / 199 AS x, lo, w, bw FROM g, s2)
SELECT {r('x')} AS x, {r('sum(cnt * exp(-0.5 * ((x - (lo + (k + 0.5) * w)) / bw) * ((x - (lo + (k + 0.5) * w)) / bw)))')} AS kernel_sum
FROM gx, c GROUP BY g, x""")
def density_q(spark, sf_dir):
    """Gaussian kernel density (Scott bandwidth) on 200 grid points from 1,000 pre-bins."""
    d = P.density(T(spark, sf_dir, "orders"), "o_totalprice", grid_points=200, pre_bins=1000)
    st = T(spark, sf_dir, "orders").agg(F.count("o_totalprice").alias("n"),
                                        F.stddev_samp("o_totalprice").alias("sd"))
    st = st.select((F.col("n") * F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
                    * F.lit((2 * 3.141592653589793) ** 0.5)).alias("scale"))
    return d.crossJoin(st).select(R("x").alias("x"), R(F.col("density") * F.col("scale")).alias("kernel_sum"))


def _box_sql(table: str, col: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON true"
    where_by = f" AND {by} IS NOT NULL" if by else ""
    return f"""
WITH base AS (SELECT {g}CAST({col} AS DOUBLE) AS x FROM {table} WHERE {col} IS NOT NULL{where_by}),
q AS (SELECT {g}count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM base {grp}),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT {g}f.n, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
  min(CASE WHEN x >= lo_f AND x <= hi_f THEN x END) AS whisker_low,
  max(CASE WHEN x >= lo_f AND x <= hi_f THEN x END) AS whisker_high,
  CAST(count_if(NOT (x >= lo_f AND x <= hi_f)) AS BIGINT) AS n_outliers
FROM base JOIN f {join} GROUP BY {g}f.n, q1, median, q3"""


@register("b27_box_stats", _box_sql("lineitem", "l_extendedprice", None))
def box_q(spark, sf_dir):
    """Quartiles, 1.5 IQR whiskers and outlier count."""
    b = P.box_stats(T(spark, sf_dir, "lineitem"), "l_extendedprice")
    return b.select("n", R("q1").alias("q1"), R("median").alias("median"), R("q3").alias("q3"),
                    "whisker_low", "whisker_high", "n_outliers")


@register("b29_matrix_quality", f"""
SELECT CAST({" + ".join(f"count_if({c} IS NULL OR isnan({c}))" for c in LI_NUM)} AS BIGINT) AS n_null,
  CAST({" + ".join(f"count_if(abs({c}) = 'inf'::DOUBLE)" for c in LI_NUM)} AS BIGINT) AS n_inf,
  {r("(" + " + ".join(f"count_if({c} <> 0)" for c in LI_NUM) + f") / (count(*) * {len(LI_NUM)})")} AS density
FROM (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LI_NUM)} FROM lineitem)""")
def matrix_quality_q(spark, sf_dir):
    """NULL / infinite counts and density of the numeric matrix."""
    m = P.matrix_quality(T(spark, sf_dir, "lineitem").select(*LI_NUM))
    return m.select("n_null", "n_inf", R("density").alias("density"))


# --------------------------------------------------------------------------
# P: row preparation
# --------------------------------------------------------------------------

@register("p1_prepare", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders")
def prepare_q(spark, sf_dir):
    """Drop id/unused columns; the target stays (last) as a column."""
    o = T(spark, sf_dir, "orders").drop("o_orderdate")
    return X.prepare(o, "o_totalprice", drop_columns=[])


@register("p2_binarise", f"SELECT doc_id, CAST(coalesce(quality > 0, false) AS INTEGER) AS quality FROM {DOCS_SQL}")
def binarise_q(spark, sf_dir):
    """``target > 0`` as 0/1, missing target → 0."""
    d = docs_labels(spark, sf_dir).select("doc_id", "quality")
    return X.prepare(d, "quality", binarise=True)


@register("p3_to_string", "SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, "
                          "CAST(nullif(l_discount, 0.0) IS NULL AS BOOLEAN) AS discount_missing FROM lineitem")
def to_string_q(spark, sf_dir):
    """Forced string columns keep NULL (no 'nan' text)."""
    li = lineitem_nulls(spark, sf_dir)
    p = X.prepare(li.select("l_orderkey", "l_linenumber", "l_discount"), "l_discount",
                  categorical_columns=["l_linenumber"])
    return p.select("l_orderkey", "l_linenumber", F.col("l_discount").isNull().alias("discount_missing"))


@register("p5_native_categorical", "SELECT l_orderkey, l_linenumber, coalesce(CAST(nullif(l_linestatus, 'F') AS VARCHAR), 'missing') AS l_linestatus, "
                                   "coalesce(l_returnflag, 'missing') AS l_returnflag FROM lineitem")
def native_cat_q(spark, sf_dir):
    """P5: non-numeric NULL → 'missing'."""
    li = lineitem_nulls(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag")
    return X.native_categorical(li)


@register("p7_usable_columns", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM "
    f"(SELECT *, 1 AS const_col FROM {DOCS_SQL})" for c in DOC_COLS + ["const_col"]) + ") WHERE n_unique > 1")
def usable_q(spark, sf_dir):
    """Drop columns with <= 1 distinct value or all missing."""
    d = docs_labels(spark, sf_dir).select(*DOC_COLS).withColumn("const_col", F.lit(1))
    prof = P.profile(d)
    return prof.where((F.col("n_unique") > 1) & (F.col("n_nonnull") > 0)).select("column_name", "n_unique")


@register("p8_dropna_pair", f"SELECT n_chars, quality FROM {DOCS_SQL} WHERE n_chars IS NOT NULL AND quality IS NOT NULL")
def dropna_q(spark, sf_dir):
    """The (feature, target) pair without rows missing either."""
    return X.drop_missing_pair(docs_labels(spark, sf_dir), "n_chars", "quality")


@register("p9_project_features", "SELECT o_totalprice, o_custkey, 0 AS absent_feature FROM orders")
def project_q(spark, sf_dir):
    """Fixed feature list; absent → 0, extra dropped."""
    return X.project_features(T(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey", "absent_feature"])


@register("p10_coerce_target", "SELECT o_orderkey, o_totalprice AS target FROM orders")
def coerce_q(spark, sf_dir):
    """P10: a string target that fully parses becomes double."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("target"))
    return X.coerce_numeric_target(o, "target")


@register("p11_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def head_q(spark, sf_dir):
    """First k rows in a stated order (top-k)."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return X.head(o, 10, [F.desc("o_totalprice"), "o_orderkey"])


# --------------------------------------------------------------------------
# X: sampling, splits, folds
# --------------------------------------------------------------------------

H_SQL = "md5('42|' || CAST(o_orderkey AS VARCHAR))"


@register("x1_sample", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {H_SQL}, o_orderkey LIMIT 1000")
def sample_q(spark, sf_dir):
    """Exactly 1,000 repeatable rows."""
    return X.sample_n(T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 1000, "o_orderkey")


@register("x3_stratified_split", f"""
SELECT o_orderkey, o_orderstatus,
  CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H_SQL}, o_orderkey)
            <= floor(0.2 * count(*) OVER (PARTITION BY o_orderstatus)) THEN 'test' ELSE 'train' END AS split
FROM orders""")
def strat_split_q(spark, sf_dir):
    """Stratified 80/20 split, exact per-stratum sizes, repeatable."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return X.train_test_split(o, "o_orderkey", 0.2, stratify="o_orderstatus")


@register("x4_random_split", f"""
SELECT o_orderkey, CASE WHEN CAST(('0x' || substr({H_SQL}, 1, 13)) AS BIGINT) / 4503599627370496.0 < 0.2
                        THEN 'test' ELSE 'train' END AS split FROM orders""")
def random_split_q(spark, sf_dir):
    """Hash split without strata (no shuffle)."""
    o = T(spark, sf_dir, "orders").select("o_orderkey")
    return X.train_test_split(o, "o_orderkey", 0.2, exact=False)


@register("x6_kfold", f"""
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY {H_SQL}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders""")
def kfold_q(spark, sf_dir):
    """Five shuffled folds."""
    return X.kfold(T(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 5)


@register("x7_stratified_kfold", f"""
SELECT o_orderkey, o_orderstatus,
  CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H_SQL}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders""")
def strat_kfold_q(spark, sf_dir):
    """Five folds stratified on the status."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return X.kfold(o, "o_orderkey", 5, stratify="o_orderstatus")


# --------------------------------------------------------------------------
# S2 and the single-column predicates B2-B11
# --------------------------------------------------------------------------

@register("s2_missing_tokens", """
SELECT c_custkey, CASE WHEN trim(c_mktsegment) IN ('?', 'name', 'n/a', 'N/A', 'na', 'NA', 'none', 'None', 'missing', 'MACHINERY')
                       THEN NULL ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_nationkey IN (0, 24) THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer""")
def missing_tokens_q(spark, sf_dir):
    """Default tokens plus a data-set token become NULL in strings; numeric sentinels (0, 24) in numbers."""
    from ..sources import io as S
    c = T(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return S.replace_tokens(c, S.DEFAULT_NA_VALUES + ["MACHINERY"], columns=["c_mktsegment", "c_nationkey"],
                            sentinels=[0, 24])


_FLAG_COLS = [("l_linenumber", "numeric"), ("l_quantity", "numeric"), ("l_extendedprice", "numeric"),
              ("l_discount", "numeric"), ("l_linestatus", "string"), ("l_returnflag", "string"), ("l_tax", "numeric")]


@register("b2_b11_column_flags", """
WITH p AS ({inner})
SELECT column_name, kind = 'numeric' AS is_numeric, kind = 'string' AS is_categorical,
  kind = 'numeric' AND n_unique = 2 AS is_binary, false AS is_datetime,
  n_unique > 50 AS is_high_cardinality, n_unique <= 20 AS is_low_cardinality,
  n_null / n_rows > 0.4 AS is_missing_heavy, n_unique <= 1 AS is_constant,
  CASE WHEN n_nonnull = 0 THEN true ELSE top_count / n_nonnull > 0.99 END AS is_near_constant
FROM p""".format(inner=_profile_sql(LINEITEM_NULLS_SQL, _FLAG_COLS, None)
                 .replace("SELECT position, column_name,", "SELECT position, column_name, kind,", 1)))
def column_flags_q(spark, sf_dir):
    """Numeric, categorical, binary, datetime, cardinality, missingness and constancy tests."""
    df = lineitem_nulls(spark, sf_dir).select(*[c for c, _ in _FLAG_COLS])
    f = P.with_flags(P.bounded_profile(df))
    return f.select("column_name", "is_numeric", "is_categorical", "is_binary", "is_datetime", "is_high_cardinality",
                    "is_low_cardinality", "is_missing_heavy", "is_constant", "is_near_constant")
