"""Running sums over a global order without a single-task window.

``Window.orderBy(x)`` without a partition key moves every row into one task.
Here the rows (usually already reduced to distinct values with counts) are cut
into contiguous ranges of the order key using approximate quantiles (a short,
bounded list of boundaries), totals per range are computed (one row per
range), their offsets are accumulated over the ranges (one row of arrays, at
most ``MAX_RANGES`` entries), and the running sum is finished inside each range.
No task holds more than one range, at any number of rows.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 1_000_000
MIN_RANGES, MAX_RANGES = 8, 16_384


def range_ids(df: DataFrame, order_col: str, rows_per_range: int = ROWS_PER_RANGE, out_col: str = "__range") -> DataFrame:
    """Add a range id that is monotone in ``order_col`` (numeric).

    One aggregation yields the row count and the few cut points (approximate
    quantiles) that ``MIN_RANGES`` ranges need. Only a table of more than
    ``MIN_RANGES * rows_per_range`` rows asks once more, for the cut points of as
    many ranges as it fills.
    """
    x = F.col(order_col).cast("double")

    def cuts(n_ranges: int):
        probs = [k / n_ranges for k in range(1, n_ranges)]
        return F.percentile_approx(x, probs, 4 * n_ranges).alias("q")

    r = df.agg(F.count(F.lit(1)).alias("n"), cuts(MIN_RANGES)).first()
    n_ranges = min(MAX_RANGES, -(-r["n"] // rows_per_range))
    q = r["q"] if n_ranges <= MIN_RANGES else df.agg(cuts(n_ranges)).first()["q"]
    splits = [float("-inf"), *sorted({float(v) for v in q or [] if v is not None}), float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    b = Bucketizer(splits=splits, inputCol="__ord", outputCol=out_col, handleInvalid="keep")
    return b.transform(df.withColumn("__ord", x)).drop("__ord")


def prefix_offsets(totals: DataFrame, key: str, cols, descending: bool = False) -> DataFrame:
    """``(key, __o_col ...)``: for each row of a short table the sums of ``cols`` over the
    rows before it by ``key``. The table becomes one row of a sorted array, and one
    pass over it carries the sums along."""
    kinds = dict(totals.dtypes)
    row = totals.agg(F.sort_array(F.collect_list(F.struct(key, *cols)), not descending).alias("a"))
    start = ", ".join(f"'{c}', CAST(0 AS {kinds[c]})" for c in cols)
    step = ", ".join(f"'{c}', CAST(acc.s.{c} + y.{c} AS {kinds[c]})" for c in cols)
    item = ", ".join([f"'{key}', y.{key}", *(f"'__o_{c}', acc.s.{c}" for c in cols)])
    kind = ", ".join([f"{key}: {kinds[key]}", *(f"__o_{c}: {kinds[c]}" for c in cols)])
    carried = (f"aggregate(a, named_struct('s', named_struct({start}), 'out', CAST(array() AS array<struct<{kind}>>)), "
               f"(acc, y) -> named_struct('s', named_struct({step}), 'out', concat(acc.out, array(named_struct({item})))), "
               "acc -> acc.out)")
    return row.select(F.explode(F.expr(carried)).alias("r")).select("r.*")


def running_sums(df: DataFrame, order_col: str, sum_cols, descending: bool = False,
                 inclusive: bool = True,
                 rows_per_range: int = ROWS_PER_RANGE, prefix: str = "cum_",
                 partition_cols=()) -> DataFrame:
    """For each row, sums of ``sum_cols`` over all rows before it in the order
    (``inclusive`` adds the row itself), separately per ``partition_cols``.
    Ties in ``order_col`` must have been merged beforehand (one row per
    distinct key and partition), which is how callers use it.
    """
    sum_cols, parts = list(sum_cols), list(partition_cols)
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    frame_end = Window.currentRow if inclusive else -1
    r = range_ids(df, order_col, rows_per_range)
    totals = r.groupBy(*parts, "__range").agg(*[F.sum(c).alias(c) for c in sum_cols])
    if parts:
        rng = F.col("__range").desc() if descending else F.col("__range").asc()
        wt = Window.partitionBy(*parts).orderBy(rng).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(*parts, "__range", *[F.coalesce(F.sum(c).over(wt), F.lit(0)).alias(f"__o_{c}") for c in sum_cols])
    else:
        offsets = prefix_offsets(totals, "__range", sum_cols, descending)
    w = Window.partitionBy(*parts, "__range").orderBy(key).rowsBetween(Window.unboundedPreceding, frame_end)
    out = r.join(offsets, [*parts, "__range"]).select(
        "*", *[(F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0))).alias(f"{prefix}{c}") for c in sum_cols])
    return out.drop("__range", *[f"__o_{c}" for c in sum_cols])


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """Tie-averaged 1-based ranks of the non-NULL values of ``column``: ``(value, rank)``."""
    vc = (df.where(F.col(column).isNotNull())
          .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("cnt")))
    rs = running_sums(vc, "value", ["cnt"], inclusive=False)
    return rs.select("value", (F.col("cum_cnt") + (F.col("cnt") + 1) / 2.0).alias("rank"))


#: Groups that are taken as columns of one bracket selection.
GROUPS_AS_COLUMNS = 32


def _few_groups(df: DataFrame, column: str, probs, by: list[str]) -> DataFrame | None:
    """``grouped_quantiles`` of at most ``GROUPS_AS_COLUMNS`` groups, as a local table: each
    group is a column of one bracket selection, so no values are shuffled. None if
    there are more groups, or keys that are no texts, whole numbers or booleans."""
    from ..functions.exprs import INTEGRAL_TYPES, nan_to_null, qc
    from .quantiles import quantile_arrays
    fields = [df.schema[b] for b in by]
    if not all(isinstance(f.dataType, (*INTEGRAL_TYPES, T.StringType, T.BooleanType)) for f in fields):
        return None
    x = nan_to_null(qc(column).cast("double"))
    own = df.select(*[qc(b).alias(f"k{i}") for i, b in enumerate(by)], x.alias("x")).dropna()
    keys = [f"k{i}" for i in range(len(by))]
    groups = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).limit(GROUPS_AS_COLUMNS + 1).collect()
    if len(groups) > GROUPS_AS_COLUMNS:
        return None

    def member(row):
        found = F.lit(True)
        for k in keys:
            found &= F.col(k) == F.lit(row[k])
        return found

    wide = own.select(*[F.when(member(row), F.col("x")).alias(f"g{i}") for i, row in enumerate(groups)])
    q = quantile_arrays(wide, wide.columns, probs)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in fields), T.StructField("n", T.LongType()),
                           T.StructField("q", T.ArrayType(T.DoubleType()))])
    return df.sparkSession.createDataFrame([(*(row[k] for k in keys), row["n"], q[f"g{i}"]) for i, row in enumerate(groups)], schema)


def grouped_quantiles(df: DataFrame, column: str, probs, by: str | list[str]) -> DataFrame:
    """Exact linear-interpolation quantiles of a numeric column per group, as a table
    ``(by..., n, q)`` with one array of quantiles a group, equal to ``percentile``.

    Few groups become columns of one bracket selection (``_few_groups``). Of more groups
    values are counted per ``(by, value)``, running counts are formed in ranges of the
    values, and each row says itself which order statistics it holds. Nothing is
    collected; a group is as many rows in the last step as it has wanted ranks.
    """
    from ..functions.exprs import nan_to_null, qc
    by = [by] if isinstance(by, str) else list(by)
    few = _few_groups(df, column, [float(p) for p in probs], by)
    if few is not None:
        return few
    keys = [f"__by{i}" for i in range(len(by))]
    probs = [float(p) for p in probs]
    base = df.select(*[qc(b).alias(k) for b, k in zip(by, keys)], nan_to_null(qc(column).cast("double")).alias("value")).where(
        " AND ".join(f"{c} IS NOT NULL" for c in [*keys, "value"]))
    vc = base.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("cnt"))
    rs = running_sums(vc, "value", ["cnt"], inclusive=True, partition_cols=keys)
    rs = rs.join(vc.groupBy(*keys).agg(F.sum("cnt").alias("n")), keys)

    def holds(rank):
        return F.when((F.col("cum_cnt") - F.col("cnt") <= rank) & (rank < F.col("cum_cnt")), F.col("value"))

    h = [(F.col("n") - 1) * F.lit(p) for p in probs]
    parts = [holds(f(x)) for x in h for f in (F.floor, F.ceil)]
    kept = rs.select(*keys, "n", *[p.alias(f"v{i}") for i, p in enumerate(parts)]).where(
        F.coalesce(*[F.col(f"v{i}") for i in range(len(parts))]).isNotNull())
    one = kept.groupBy(*keys, "n").agg(*[F.max(f"v{i}").alias(f"v{i}") for i in range(len(parts))])
    q = [F.when(F.col(f"v{2 * i}") == F.col(f"v{2 * i + 1}"), F.col(f"v{2 * i}"))
         .otherwise(F.col(f"v{2 * i}") + (x - F.floor(x)) * (F.col(f"v{2 * i + 1}") - F.col(f"v{2 * i}"))) for i, x in enumerate(h)]
    return one.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], "n", F.array(*q).alias("q"))
