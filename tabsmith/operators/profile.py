"""Column profiling and semantic type detection.

Shape of the work: ``profile`` reads the data once — a long aggregation over
``(column, value)`` items (NULLs included) whose value counts give every
statistic; map-side partial aggregation collapses hot values, so a value
holding a third of all rows costs one row per map task. ``wide_stats`` (one
aggregation, one row per column) serves the cheap summaries (B19-B21, B29).

Profiles are local tables with one row per column; only tables bounded by the
number of columns are ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import (as_number, field_kinds, is_float_type, nan_to_null, qc,
                               safe_timestamp)

# Fixed thresholds of the semantic typing rules.
LOW_CARDINALITY = 20        # numeric with at most this many values is categorical/ordinal
HIGH_CARDINALITY = 50       # "high cardinality" test of single columns
DATETIME_PARSE_RATE = 0.8   # share of non-null strings that must parse as dates
MISSING_HEAVY = 0.4
NEAR_CONSTANT = 0.99

FEATURE_TYPES = ["numeric", "binary", "categorical", "high_cardinality", "datetime", "ordinal"]


def _profiled_columns(df: DataFrame, columns=None) -> list[tuple[int, str, str]]:
    kinds = field_kinds(df)
    names = columns if columns is not None else df.columns
    return [(i, c, kinds[c]) for i, c in enumerate(names) if kinds[c] != "other"]


def _num(df: DataFrame, c: str) -> Column:
    dtype = df.schema[c].dataType
    x = as_number(qc(c), dtype)
    return nan_to_null(x) if is_float_type(dtype) else x


def _value(df: DataFrame, c: str) -> Column:
    dtype = df.schema[c].dataType
    col = qc(c)
    if is_float_type(dtype):
        col = nan_to_null(col)
    return col.cast("string")


def wide_stats(df: DataFrame, columns=None, datetime_formats=None) -> DataFrame:
    """One-row aggregation unpivoted to one row per column."""
    cols = _profiled_columns(df, columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c, kind in cols:
        if kind in ("numeric", "boolean"):
            x = _num(df, c)
            aggs += [
                F.count(x).alias(f"nn{i}"),
                F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                F.avg(x).alias(f"av{i}"), F.stddev_samp(x).alias(f"sd{i}"),
                F.count_if(x == 0).alias(f"z{i}"),
                F.count_if(F.abs(x) == float("inf")).alias(f"inf{i}"),
            ]
        else:
            aggs.append(F.count(qc(c)).alias(f"nn{i}"))
        if kind == "string":
            aggs.append(F.count(safe_timestamp(qc(c), datetime_formats)).alias(f"dt{i}"))
    one = df.agg(*aggs)
    null_d = F.lit(None).cast("double")
    null_l = F.lit(None).cast("long")
    rows = []
    for i, c, kind in cols:
        numeric = kind in ("numeric", "boolean")
        rows.append(F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(kind).alias("kind"),
            F.lit(df.schema[c].dataType.simpleString()).alias("spark_type"),
            F.col("__n").alias("n_rows"),
            F.col(f"nn{i}").alias("n_nonnull"),
            (F.col(f"mn{i}") if numeric else null_d).alias("min"),
            (F.col(f"mx{i}") if numeric else null_d).alias("max"),
            (F.col(f"av{i}") if numeric else null_d).alias("mean"),
            (F.col(f"sd{i}") if numeric else null_d).alias("sd"),
            (F.col(f"z{i}") if numeric else null_l).alias("zero_count"),
            (F.col(f"inf{i}") if numeric else null_l).alias("inf_count"),
            (F.col(f"dt{i}") if kind == "string" else null_l).alias("n_parsed_datetime"),
        ))
    return (one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            .withColumn("n_null", F.col("n_rows") - F.col("n_nonnull")))


def value_counts_long(df: DataFrame, columns=None, target: str | Column | None = None,
                      keep_nulls: bool = False) -> DataFrame:
    """B22 for many columns at once: ``(column_name, value, num, cnt[, t_mean])``.

    ``value`` is the string form, ``num`` the numeric form (for ordering numeric
    values), ``t_mean`` the mean target among rows with that value. Numbers are
    grouped by their native value (integers exactly, as longs) and formatted
    only once per distinct value.
    """
    cols = _profiled_columns(df, columns)
    null_s, null_l, null_d = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("double")
    items = []
    for _, c, kind in cols:
        dtype = df.schema[c].dataType
        integral = kind == "boolean" or isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        s_ = null_s if kind in ("numeric", "boolean") else _value(df, c)
        i_ = qc(c).cast("int").cast("long") if kind == "boolean" else qc(c).cast("long") if integral else null_l
        d_ = _num(df, c) if kind == "numeric" and not integral else null_d
        items.append(F.struct(F.lit(c).alias("column_name"), s_.alias("s"), i_.alias("i"), d_.alias("d")))
    sel = [F.explode(F.array(*items)).alias("kv")]
    if target is not None:
        t = qc(target) if isinstance(target, str) else target
        sel.append(t.try_cast("double").alias("__t"))
    long = df.select(*sel).select("kv.*", *(["__t"] if target is not None else []))
    aggs = [F.count(F.lit(1)).alias("cnt")]
    if target is not None:
        aggs.append(F.avg("__t").alias("t_mean"))
    present = F.col("s").isNotNull() | F.col("i").isNotNull() | F.col("d").isNotNull()
    g = (long if keep_nulls else long.where(present)).groupBy("column_name", "s", "i", "d").agg(*aggs)
    value = F.coalesce(F.col("s"), F.col("i").cast("string"), F.col("d").cast("string"))
    num = F.coalesce(F.col("i").cast("double"), F.col("d"))
    return g.select("column_name", value.alias("value"), num.alias("num"), "cnt",
                    *(["t_mean"] if target is not None else []))


def column_counts(vc: DataFrame) -> DataFrame:
    """Per-column exact distinct count, top value and top count from value counts."""
    return vc.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_unique"),
        F.max("cnt").alias("top_count"),
        # highest count, lowest value on ties — deterministic
        F.min_by("value", F.struct((-F.col("cnt")).alias("k"), F.col("value").alias("v"))).alias("top_value"),
    )


def _monotone(points) -> bool:
    """B12 on <= low_card points sorted by value: mean target never decreases or never increases."""
    means = [m for _, m in sorted(points)]
    if len(means) < 3 or any(m is None for m in means):
        return False
    inc = all(b >= a for a, b in zip(means, means[1:]))
    dec = all(b <= a for a, b in zip(means, means[1:]))
    return inc or dec


def profile(df: DataFrame, columns=None, target: str | Column | None = None,
            low_card: int = LOW_CARDINALITY, datetime_formats=None) -> DataFrame:
    """B1: the column profile (plus the ordinal test B12 when a target is given).

    ONE scan of the data: every row emits one ``(column, value)`` item per
    column (NULLs included) and map-side partial aggregation reduces them to
    value counts, persisted while used. Everything else works on those counts:
    n, NULLs, distinct values, top value, min/max, mean and (centred, second
    pass over the counts) standard deviation, zero and infinity counts, date
    parsing (once per distinct string) and — only for numeric columns proven to
    hold 3..low_card values — the ``(value, mean target)`` points. The result
    is a local table with one row per column.

    Columns: position, column_name, kind, spark_type, n_rows, n_nonnull, n_null,
    n_unique, top_value, top_count, top_share, missing_ratio, min, max, mean, sd,
    zero_count, inf_count, n_parsed_datetime, parse_rate, is_ordinal.
    """
    import math

    from pyspark import StorageLevel
    if isinstance(target, str) and columns is None:
        columns = [c for c in df.columns if c != target]
    spark = df.sparkSession
    cols = _profiled_columns(df, columns)
    kinds = {c: k for _, c, k in cols}
    vc = value_counts_long(df, columns, target, keep_nulls=True).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        nn = F.col("value").isNotNull()
        parsed = F.when(F.col("column_name").isin([c for c, k in kinds.items() if k == "string"] or [""]) & nn,
                        safe_timestamp(F.col("value"), datetime_formats))
        first = {r["column_name"]: r.asDict() for r in vc.groupBy("column_name").agg(
            F.sum("cnt").alias("n_rows"),
            F.sum(F.when(~nn, F.col("cnt")).otherwise(0)).alias("n_null"),
            F.count(F.when(nn, 1)).alias("n_unique"),
            F.max(F.when(nn, F.col("cnt"))).alias("top_count"),
            F.min_by(F.when(nn, F.col("value")),
                     F.when(nn, F.struct((-F.col("cnt")).alias("k"), F.col("value").alias("v")))).alias("top_value"),
            F.min("num").alias("min"), F.max("num").alias("max"),
            F.sum(F.col("cnt") * F.col("num")).alias("sx"),
            F.sum(F.when(F.col("num") == 0, F.col("cnt")).otherwise(0)).alias("zero_count"),
            F.sum(F.when(F.abs(F.col("num")) == float("inf"), F.col("cnt")).otherwise(0)).alias("inf_count"),
            F.sum(F.when(parsed.isNotNull(), F.col("cnt")).otherwise(0)).alias("n_parsed"),
        ).collect()}
        means = {}
        for c, r in first.items():
            n_nn = r["n_rows"] - r["n_null"]
            if kinds[c] in ("numeric", "boolean") and n_nn > 0 and r["sx"] is not None:
                means[c] = r["sx"] / n_nn
        sds = {}
        if means:
            mean_df = spark.createDataFrame([(c, float(m)) for c, m in means.items()], "column_name string, __m double")
            for r in (vc.join(F.broadcast(mean_df), "column_name")            # one row per column
                      .groupBy("column_name")
                      .agg(F.sum(F.col("cnt") * (F.col("num") - F.col("__m")) * (F.col("num") - F.col("__m"))).alias("ss"))
                      .collect()):
                sds[r["column_name"]] = r["ss"]
        ordinal = {}
        if target is not None:
            cand = [c for c, r in first.items() if kinds[c] in ("numeric", "boolean") and 3 <= r["n_unique"] <= low_card]
            if cand:
                pts = (vc.where(F.col("column_name").isin(cand) & nn)
                       .groupBy("column_name").agg(F.collect_list(F.struct("num", "t_mean")).alias("pts"))
                       .collect())
                ordinal = {r["column_name"]: _monotone([(p["num"], p["t_mean"]) for p in r["pts"]]) for r in pts}
    finally:
        vc.unpersist()
    rows = []
    for pos, c, kind in cols:
        r = first.get(c, {})
        n = int(r.get("n_rows") or 0)
        n_null = int(r.get("n_null") or 0)
        n_nn = n - n_null
        numeric = kind in ("numeric", "boolean")
        top_count = int(r.get("top_count") or 0)
        ss = sds.get(c)
        sd = math.sqrt(ss / (n_nn - 1)) if (ss is not None and n_nn > 1) else None
        n_parsed = int(r.get("n_parsed") or 0) if kind == "string" else None
        rows.append((pos, c, kind, df.schema[c].dataType.simpleString(), n, n_nn, n_null, int(r.get("n_unique") or 0),
                     r.get("top_value"), top_count, (top_count / n_nn) if n_nn else None,
                     (n_null / n) if n else None,
                     r.get("min") if numeric else None, r.get("max") if numeric else None,
                     means.get(c) if numeric else None, sd if numeric else None,
                     int(r.get("zero_count") or 0) if numeric else None,
                     int(r.get("inf_count") or 0) if numeric else None,
                     n_parsed, (n_parsed / n_nn) if (n_parsed is not None and n_nn) else None,
                     bool(ordinal.get(c, False))))
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def with_flags(prof: DataFrame, high_card: int = HIGH_CARDINALITY, low_card: int = LOW_CARDINALITY,
               missing_heavy: float = MISSING_HEAVY, near_constant: float = NEAR_CONSTANT,
               parse_rate: float = DATETIME_PARSE_RATE) -> DataFrame:
    """B2-B11 as boolean columns on a profile."""
    numeric = F.col("kind").isin("numeric", "boolean")
    return prof.select(
        "*",
        numeric.alias("is_numeric"),
        F.col("kind").isin("string", "boolean").alias("is_categorical"),
        (numeric & (F.col("n_unique") == 2)).alias("is_binary"),
        ((F.col("kind") == "datetime")
         | ((F.col("kind") == "string") & (F.col("n_nonnull") > 0)
            & (F.coalesce(F.col("parse_rate"), F.lit(0.0)) >= parse_rate))).alias("is_datetime"),
        (F.col("n_unique") > high_card).alias("is_high_cardinality"),
        (F.col("n_unique") <= low_card).alias("is_low_cardinality"),
        (F.col("missing_ratio") > missing_heavy).alias("is_missing_heavy"),
        (F.col("n_unique") <= 1).alias("is_constant"),
        F.when(F.col("n_nonnull") == 0, F.lit(True))
         .otherwise(F.coalesce(F.col("top_share") > near_constant, F.lit(False))).alias("is_near_constant"),
    )


def feature_type_expr(low_card: int = LOW_CARDINALITY, force_ordinal=(), force_nominal=(),
                      parse_rate: float = DATETIME_PARSE_RATE) -> Column:
    """The fixed-order typing rule over profile columns."""
    name = F.col("column_name")
    numeric = F.col("kind").isin("numeric", "boolean")
    n_unique = F.col("n_unique")
    rule = F.when(name.isin(list(force_ordinal)) if force_ordinal else F.lit(False), "ordinal")
    rule = rule.when(name.isin(list(force_nominal)) if force_nominal else F.lit(False), "categorical")
    rule = (rule
            .when(F.col("kind") == "datetime", "datetime")
            .when((F.col("kind") == "string") & (F.col("n_nonnull") > 0)
                  & (F.coalesce(F.col("parse_rate"), F.lit(0.0)) >= parse_rate), "datetime")
            .when(numeric & (n_unique == 2), "binary")
            .when(numeric & (n_unique <= low_card) & F.col("is_ordinal"), "ordinal")
            .when(numeric & (n_unique <= low_card), "categorical")
            .when(numeric, "numeric")
            .when(n_unique <= low_card, "categorical")
            .otherwise("high_cardinality"))
    return rule


def detect_feature_types(df: DataFrame, target: str | Column | None = None, config: dict | None = None,
                         columns=None) -> DataFrame:
    """Profile plus ``feature_type``; one row per column, input order in ``position``.

    ``config`` keys: ``low_cardinality_threshold`` and ``feature_type_overrides``
    (``ordinal`` / ``nominal`` lists), ``datetime_formats``.
    """
    config = config or {}
    low_card = config.get("low_cardinality_threshold", LOW_CARDINALITY)
    overrides = config.get("feature_type_overrides", {}) or {}
    prof = profile(df, columns=columns, target=target, low_card=low_card,
                   datetime_formats=config.get("datetime_formats"))
    return prof.withColumn("feature_type", feature_type_expr(
        low_card, overrides.get("ordinal", []), overrides.get("nominal", [])))


#: Up to about this many values a column is counted value by value in the bounded profile.
COUNTED_VALUES = 1_000

PROFILE_SCHEMA = ("position int, column_name string, kind string, spark_type string, n_rows long, n_nonnull long, "
                  "n_null long, n_unique long, top_value string, top_count long, top_share double, missing_ratio double, "
                  "min double, max double, mean double, sd double, zero_count long, inf_count long, "
                  "n_parsed_datetime long, parse_rate double, is_ordinal boolean")


def bounded_profile(df: DataFrame, columns=None, target: str | Column | None = None,
                    low_card: int = LOW_CARDINALITY, datetime_formats=None) -> DataFrame:
    """The profile (columns as ``profile``) that every threshold test needs, without a
    row per distinct value.

    1. One wide aggregation: counts, moments, parsed dates, an estimate of the distinct
       values and, per column, the median of the values' hashes. What is exchanged is
       one row per task. A value that more than half of the rows hold stands in
       the middle of any order, so the median hash is its hash.
    2. Columns of at most about ``COUNTED_VALUES`` values are counted exactly, value by
       value (and tested for an ordinal trend against ``target``). Of the others only
       that one candidate is counted.

    So ``n_unique`` is exact up to that limit and the estimate beyond; ``top_value``
    and ``top_count`` are exact there, and beyond it given only for a value of more than
    half of the rows (else NULL). No threshold of the typing and cleaning rules falls between.
    """
    if isinstance(target, str) and columns is None:
        columns = [c for c in df.columns if c != target]
    cols = _profiled_columns(df, columns)
    wide = {r["column_name"]: r for r in wide_stats(df, columns, datetime_formats).collect()}
    if not cols:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    own = [nan_to_null(qc(c)) if is_float_type(df.schema[c].dataType) else qc(c) for _, c, _ in cols]
    keys = [F.when(x.isNotNull(), F.xxhash64(x)) for x in own]
    aggs = [f for x, k in zip(own, keys) for f in (F.approx_count_distinct(x, 0.03), F.percentile_approx(k, 0.5, 100))]
    seen = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
    # at such counts the estimate is off by a few percent; twice the limit of any rule leaves no doubt
    few = [c for i, (_, c, _) in enumerate(cols) if seen[2 * i] <= COUNTED_VALUES]
    exact, points = {}, {}
    if few:
        counts = value_counts_long(df, few, target)
        trend = [F.struct("num", "t_mean")] if target is not None else []
        near = F.collect_list(trend[0]).alias("pts") if trend else F.lit(None).alias("pts")
        for r in (counts.groupBy("column_name").agg(
                F.count(F.lit(1)).alias("n_unique"), F.max("cnt").alias("top_count"),
                F.min_by("value", F.struct((-F.col("cnt")).alias("k"), F.col("value").alias("v"))).alias("top_value"), near).collect()):
            exact[r["column_name"]] = r
            points[r["column_name"]] = [(p["num"], p["t_mean"]) for p in r["pts"] or []]
    many = [i for i, (_, c, _) in enumerate(cols) if c not in exact and seen[2 * i + 1] is not None]
    candidate = {}
    if many:
        hit = [(keys[i] == seen[2 * i + 1]) for i in many]
        one = df.agg(*[f for h, i in zip(hit, many) for f in (
            F.count_if(h), F.max(F.when(h, own[i].cast("string"))))]).first()
        candidate = {cols[i][1]: (one[2 * j], one[2 * j + 1]) for j, i in enumerate(many)}
    rows = []
    for i, (pos, c, kind) in enumerate(cols):
        w, r = wide[c], exact.get(c)
        numeric, nonnull = kind in ("numeric", "boolean"), w["n_nonnull"]
        top_count, top_value = (r["top_count"], r["top_value"]) if r else candidate.get(c, (None, None))
        if not r and nonnull and not (top_count or 0) * 2 > nonnull:
            top_count = top_value = None
        n_unique = r["n_unique"] if r else seen[2 * i]
        ordinal = numeric and target is not None and r is not None and 3 <= n_unique <= low_card and _monotone(points[c])
        parsed = w["n_parsed_datetime"]
        rows.append((pos, c, kind, w["spark_type"], w["n_rows"], nonnull, w["n_null"], n_unique, top_value,
                     top_count if nonnull else 0, top_count / nonnull if top_count and nonnull else None,
                     w["n_null"] / w["n_rows"] if w["n_rows"] else None, w["min"], w["max"], w["mean"], w["sd"],
                     w["zero_count"], w["inf_count"], parsed, parsed / nonnull if parsed is not None and nonnull else None, bool(ordinal)))
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def typed_columns(df: DataFrame, target: str | Column | None = None, config: dict | None = None, columns=None) -> DataFrame:
    """B13 without the full profile: ``(position, column_name, kind, n_nonnull, n_unique,
    parse_rate, is_ordinal, feature_type)`` from the bounded one."""
    config = config or {}
    low_card = config.get("low_cardinality_threshold", LOW_CARDINALITY)
    overrides = config.get("feature_type_overrides", {}) or {}
    prof = bounded_profile(df, columns, target, low_card, config.get("datetime_formats"))
    return prof.select("position", "column_name", "kind", "n_nonnull", "n_unique", "parse_rate", "is_ordinal",
                       feature_type_expr(low_card, overrides.get("ordinal", []), overrides.get("nominal", [])).alias("feature_type"))


def feature_type_map(types_df: DataFrame) -> dict[str, list[str]]:
    """Dict view ``{feature_type: [columns in input order]}`` with all six keys.

    Collects one row per column (bounded by the schema width, not the data).
    """
    out = {k: [] for k in FEATURE_TYPES}
    for r in types_df.select("position", "column_name", "feature_type").orderBy("position").collect():
        out[r["feature_type"]].append(r["column_name"])
    return out


# --------------------------------------------------------------------------
# EDA typing and cleaning
# --------------------------------------------------------------------------

def eda_types(prof: DataFrame, max_categories: int = LOW_CARDINALITY) -> DataFrame:
    """Numeric with <= max_categories values counts as categorical."""
    numeric = F.col("kind").isin("numeric")
    return prof.select("position", "column_name", F.when(
        numeric & (F.col("n_unique") > max_categories), "numeric")
        .when(numeric | F.col("kind").isin("string", "boolean"), "categorical")
        .otherwise(F.lit(None)).alias("eda_type"))


def stable_categoricals(prof: DataFrame, max_unique: int = 50, max_missing_ratio: float = 0.5,
                        min_freq_ratio: float = 0.01, max_categories: int = LOW_CARDINALITY) -> DataFrame:
    """Categorical columns kept for association statistics.

    All-missing columns are dropped first (they have no top value).
    """
    cats = eda_types(prof, max_categories).where(F.col("eda_type") == "categorical").select("column_name")
    return (prof.join(cats, "column_name")
            .where((F.col("n_nonnull") > 0)
                   & (F.col("n_unique") <= max_unique)
                   & (F.col("missing_ratio") <= max_missing_ratio)
                   & F.coalesce(F.col("top_share") <= 1 - min_freq_ratio, F.lit(True)))
            .select("position", "column_name"))


def problem_type(df: DataFrame, target: str, max_classes: int = LOW_CARDINALITY) -> DataFrame:
    """B16 (EDA rule) and B17 (trainer rule) from one aggregation of the target column."""
    kind = field_kinds(df)[target]
    dtype = df.schema[target].dataType
    n_unique = F.count_distinct(qc(target))
    integral = kind == "boolean" or dtype.typeName() in ("byte", "short", "integer", "long")
    res = df.agg(n_unique.alias("n_unique"))
    eda = (F.lit("classification") if kind in ("string", "boolean")
           else F.when(F.lit(kind == "numeric") & (F.col("n_unique") <= max_classes), "classification")
           .otherwise("regression"))
    trainer = F.when(F.lit(integral) & (F.col("n_unique") <= max_classes), "classification").otherwise("regression")
    return res.select(F.lit(target).alias("target"), "n_unique",
                      eda.alias("problem_type"), trainer.alias("trainer_task"))


# --------------------------------------------------------------------------
# Summaries
# --------------------------------------------------------------------------

def info(df: DataFrame) -> DataFrame:
    """Schema and non-null count per column."""
    return wide_stats(df).select("position", "column_name", "spark_type", "n_nonnull")


def missing_counts(df: DataFrame) -> DataFrame:
    """Columns with at least one missing value, ascending by count."""
    return (wide_stats(df).where(F.col("n_null") > 0)
            .select("column_name", F.col("n_null").alias("missing_count"))
            .orderBy("missing_count", "column_name"))


def zeroness(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Zeros per numeric column over ALL rows, heavy flag, descending."""
    w = wide_stats(df).where(F.col("kind") == "numeric")
    return (w.select("column_name", F.col("zero_count"),
                     (F.col("zero_count") / F.col("n_rows")).alias("zero_pct"))
            .withColumn("zero_heavy", F.col("zero_pct") > threshold)
            .orderBy(F.desc("zero_count"), "column_name"))


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Counts (and shares of non-null rows) per value, descending."""
    vc = df.where(qc(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        # the total is a one-row aggregate joined back (no global window)
        total = df.agg(F.count(qc(column)).alias("__tot"))
        vc = vc.crossJoin(F.broadcast(total)).select(
            column, "count", (F.col("count") / F.col("__tot")).alias("share"))
    return vc.orderBy(F.desc("count"), column)


def top_n_summary(df: DataFrame, column: str, top_n: int = 20) -> tuple[DataFrame, DataFrame]:
    """The top-n values and the share of non-null rows outside them."""
    vc = df.where(qc(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    top = vc.orderBy(F.desc("count"), column).limit(top_n)
    total = df.agg(F.count(qc(column)).alias("n"))
    top_sum = top.agg(F.sum("count").alias("top_rows"))
    rare = total.crossJoin(top_sum).select(
        F.lit(column).alias("column_name"),
        F.coalesce(F.col("n") - F.col("top_rows"), F.lit(0)).alias("rare_rows"),
        (100.0 * F.try_divide(F.col("n") - F.col("top_rows"), F.col("n"))).alias("rare_pct"))
    return top, rare


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max; the maximum joins the last bin.

    Output: bin (1..bins), lower, upper, count — empty bins included.
    """
    x = nan_to_null(qc(column).cast("double"))
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0))
    b = F.least(F.floor((F.col("__x") - F.col("lo")) / F.col("__w")) + 1, F.lit(bins)).cast("int")
    counted = (df.select(x.alias("__x")).where(F.col("__x").isNotNull())
               .crossJoin(F.broadcast(mm.withColumn("__w", width)))
               .select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = mm.withColumn("__w", width).select(
        "lo", "__w", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return (grid.join(counted, "bin", "left")
            .where(F.col("lo").isNotNull())
            .select("bin",
                    (F.col("lo") + (F.col("bin") - 1) * F.col("__w")).alias("lower"),
                    (F.col("lo") + F.col("bin") * F.col("__w")).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def density(df: DataFrame, column: str, grid_points: int = 200, pre_bins: int = 1000) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth.

    The data are first reduced to ``pre_bins`` weighted bin centres (one
    aggregation), so the kernel sum costs pre_bins x grid_points, independent
    of the row count.
    """
    x = nan_to_null(qc(column).cast("double"))
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"),
                F.stddev_samp(x).alias("sd"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    st = st.withColumn("__w", F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / pre_bins)
                       .otherwise(F.lit(1.0)))
    centres = (df.select(x.alias("__x")).where(F.col("__x").isNotNull())
               .crossJoin(F.broadcast(st))
               .select(F.least(F.floor((F.col("__x") - F.col("lo")) / F.col("__w")), F.lit(pre_bins - 1)).alias("k"))
               .groupBy("k").agg(F.count(F.lit(1)).alias("w")))
    grid = st.select("lo", "hi", "n", "bw", "__w",
                     F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("g"))
    grid = grid.withColumn("x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("g") / (grid_points - 1))
    pairs = grid.crossJoin(F.broadcast(centres))  # centres: <= pre_bins rows, bounded
    c = F.col("lo") + (F.col("k") + 0.5) * F.col("__w")
    z = (F.col("x") - c) / F.col("bw")
    return (pairs.groupBy("g", "x", "n", "bw")
            .agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
            .select("x", (F.col("s") / (F.col("n") * F.col("bw") * F.lit((2 * 3.141592653589793) ** 0.5))).alias("density"))
            .orderBy("x"))


#: Groups whose statistics are sent to all tasks.
BROADCAST_GROUPS = 10_000


def box_stats(df: DataFrame, column: str, by: str | list[str] | None = None, approx: bool = False,
              accuracy: int = 100000) -> DataFrame:
    """B27 (and A18 when ``by`` is given, one column or several): quartiles, 1.5·IQR
    whiskers, outlier count.

    Exact quartiles are interpolated as by ``percentile``;
    ``approx=True`` switches to ``percentile_approx`` for very large groups.
    """
    x = nan_to_null(qc(column).cast("double"))
    keys = [] if by is None else [by] if isinstance(by, str) else list(by)
    base = df.select(*[qc(k) for k in keys], x.alias("__x")).where(F.col("__x").isNotNull())
    for k in keys:
        base = base.where(qc(k).isNotNull())
    probs = [0.25, 0.5, 0.75]
    if approx:
        q = F.percentile_approx("__x", probs, accuracy)
        qs = base.groupBy(*[qc(k) for k in keys]).agg(q.alias("q"), F.count(F.lit(1)).alias("n"))
    elif keys:
        from .ranking import grouped_quantiles
        qs = grouped_quantiles(base, "__x", probs, keys)
    else:
        from .quantiles import quantile_arrays
        qs = base.agg(F.count(F.lit(1)).alias("n")).withColumn(
            "q", F.array(*[F.lit(v).cast("double") for v in quantile_arrays(base, ["__x"], probs)["__x"]]))
    qs = qs.select(*[qc(k) for k in keys], "n", *[F.col("q")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))])
    qs = qs.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
           .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    if keys:
        # a few groups hold all rows: their statistics go to the rows, not the rows to their group
        known = qs.limit(BROADCAST_GROUPS + 1).collect()
        if len(known) <= BROADCAST_GROUPS:
            qs = F.broadcast(df.sparkSession.createDataFrame(known, qs.schema))
    joined = base.join(qs, keys) if keys else base.crossJoin(F.broadcast(qs))     # one row without groups
    inside = (F.col("__x") >= F.col("lo_fence")) & (F.col("__x") <= F.col("hi_fence"))
    out = joined.groupBy(*[qc(k) for k in keys]).agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("__x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return out


def describe(df: DataFrame, columns=None) -> DataFrame:
    """Pandas ``describe(include='all')`` in long form, one row per column.

    count, unique/top/freq (strings), mean, std, min, 25%, 50%, 75%, max (numbers).
    """
    prof = profile(df, columns)
    cols = _profiled_columns(df, columns)
    numeric = [(i, c) for i, c, k in cols if k in ("numeric", "boolean")]
    if numeric:
        from .quantiles import quantile_arrays
        num_df = df.select(*[_num(df, c).alias(c) for _, c in numeric])
        qa = quantile_arrays(num_df, [c for _, c in numeric], [0.25, 0.5, 0.75])
        qs = df.sparkSession.createDataFrame([(c, v) for c, v in qa.items()], "column_name string, q array<double>")
        prof = prof.join(F.broadcast(qs), "column_name", "left")      # one row per column
    else:
        prof = prof.withColumn("q", F.lit(None).cast("array<double>"))
    is_str = F.col("kind").isin("string", "boolean", "datetime")
    return prof.select(
        "position", "column_name", F.col("n_nonnull").alias("count"),
        F.when(is_str, F.col("n_unique")).alias("unique"),
        F.when(is_str, F.col("top_value")).alias("top"),
        F.when(is_str, F.col("top_count")).alias("freq"),
        "mean", F.col("sd").alias("std"), "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def matrix_quality(df: DataFrame, columns=None) -> DataFrame:
    """NULL count, infinite count and density (share of cells != 0) of a numeric matrix."""
    kinds = field_kinds(df)
    cols = [c for c in (columns or df.columns) if kinds[c] in ("numeric", "boolean")]
    if not cols:
        return df.sparkSession.createDataFrame([(0, 0, 0, 0)], "n_null long, n_inf long, n_nonzero long, n_cells long") \
            .select("n_null", "n_inf", F.lit(None).cast("double").alias("density"))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        x = qc(c).cast("double")
        aggs += [F.count_if(x.isNull() | F.isnan(x)).alias(f"nl{i}"),
                 F.count_if(F.abs(x) == float("inf")).alias(f"in{i}"),
                 F.count_if(x != 0).alias(f"nz{i}")]
    one = df.agg(*aggs)
    n_null = sum((F.col(f"nl{i}") for i in range(len(cols))), F.lit(0))
    n_inf = sum((F.col(f"in{i}") for i in range(len(cols))), F.lit(0))
    n_nz = sum((F.col(f"nz{i}") for i in range(len(cols))), F.lit(0))
    return one.select(n_null.cast("long").alias("n_null"), n_inf.cast("long").alias("n_inf"),
                      F.try_divide(n_nz, F.col("n") * len(cols)).cast("double").alias("density"))
