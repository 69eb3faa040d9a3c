"""Row preparation (P1-P11), sampling and splitting.

Splits and folds are *columns*, not separate materialised frames: a repeatable
hash of ``seed | key`` orders the rows, so re-running a split on the same data
gives the same rows without storing indices.

Exact-size splits need the rank of every row inside its stratum. A plain
``row_number()`` over ``partitionBy(stratum)`` would sort a whole stratum in one
task; instead the hash order is cut into buckets (a hex prefix of the digest),
bucket sizes are counted (a table bounded by the number of buckets, not rows),
their running offsets are computed per stratum, and rows are ranked only
inside their (stratum, bucket). The largest sorted group is one bucket, so a
stratum holding a third of all rows is split across thousands of tasks.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash_unit, kind_of, seeded_hash
from .ranking import prefix_offsets

DEFAULT_SEED = 42
#: Rows that make a partition of a split that is kept for the many jobs that read it.
ROWS_A_PARTITION = 100_000


# --------------------------------------------------------------------------
# P: projections and row preparation
# --------------------------------------------------------------------------

def prepare(df: DataFrame, target: str, drop_columns=(), binarise: bool = False,
            categorical_columns=()) -> DataFrame:
    """Drop id columns, optionally binarise the target, cast columns to string.

    The target stays a column (the last one). String casts keep NULL.
    """
    drop = set(drop_columns) | {target}
    cols = []
    for c in df.columns:
        if c in drop:
            continue
        col = F.col(c)
        if c in categorical_columns:
            col = col.cast("string")
        cols.append(col.alias(c))
    t = binarise_target(F.col(target)) if binarise else F.col(target)
    return df.select(*cols, t.alias(target))


def binarise_target(t: Column) -> Column:
    """``t > 0`` as 0/1; a missing target counts as 0."""
    return F.coalesce(t > 0, F.lit(False)).cast("int")


def add_domain_features(df: DataFrame, fn=None) -> DataFrame:
    """User hook for domain features (``df.transform(fn)``); identity by default."""
    return df if fn is None else df.transform(fn)


def native_categorical(df: DataFrame) -> DataFrame:
    """P5: every non-numeric column as string with NULL → 'missing'."""
    out = []
    for f in df.schema.fields:
        if kind_of(f.dataType) == "numeric":
            out.append(F.col(f.name))
        else:
            out.append(F.coalesce(F.col(f.name).cast("string"), F.lit("missing")).alias(f.name))
    return df.select(*out)


def categorical_positions(df: DataFrame) -> list[int]:
    """0-based positions of non-numeric columns."""
    return [i for i, f in enumerate(df.schema.fields) if kind_of(f.dataType) != "numeric"]


def drop_missing_pair(df: DataFrame, feature: str, target: str) -> DataFrame:
    """The pair ``(feature, target)`` without rows missing either."""
    return df.select(feature, target).dropna(subset=[feature, target])


def project_features(df: DataFrame, features) -> DataFrame:
    """Exactly ``features`` in order; absent columns become 0, extra ones are dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(0).alias(c) for c in features])


def coerce_numeric_target(df: DataFrame, target: str) -> DataFrame:
    """P10: a string target becomes double when every non-null value parses."""
    if kind_of(df.schema[target].dataType) != "string":
        return df
    parsed = F.col(target).try_cast("double")
    ok = df.agg(F.bool_and(parsed.isNotNull() | F.col(target).isNull()).alias("ok")).collect()[0]["ok"]
    if ok is False:
        return df
    return df.withColumn(target, parsed)


def head(df: DataFrame, k: int, order_by) -> DataFrame:
    """The first k rows in a stated order (top-k, no full sort)."""
    return df.orderBy(*([order_by] if isinstance(order_by, (str, Column)) else order_by)).limit(k)


# --------------------------------------------------------------------------
# X: sampling, splits, folds
# --------------------------------------------------------------------------

def sample_n(df: DataFrame, n: int, key, seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run.

    Rows are ordered by ``md5(seed|key)``; ``limit`` after ``orderBy`` plans as
    a top-k (TakeOrderedAndProject), so only n rows per task reach the driver side.
    """
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    return (df.withColumn("__h", seeded_hash(seed, *keys))
            .orderBy("__h", *keys).limit(n).drop("__h"))


def _bucket_bits(n_rows: int, rows_per_bucket: int = 50_000) -> int:
    """Hex digits of the digest prefix used as bucket (4 bits each), 2..6."""
    need = max(1, math.ceil(n_rows / rows_per_bucket))
    bits = max(8, min(24, math.ceil(math.log2(need)) + 4))
    return bits // 4


def hash_rank(df: DataFrame, key, strata=None, seed: int = DEFAULT_SEED,
              n_rows: int | None = None) -> DataFrame:
    """Add ``__rank`` (1-based rank inside the stratum by ``md5(seed|key)``) and ``__n`` (stratum size).

    Ranks are exact and equal ``row_number() over (partition by strata order by
    md5, key)``, but no task ever sorts more than one hash bucket.
    """
    keys = [key] if isinstance(key, str) else list(key)
    strata = [] if strata is None else ([strata] if isinstance(strata, str) else list(strata))
    if n_rows is None:
        n_rows = df.count()
    digits = _bucket_bits(n_rows)
    h = seeded_hash(seed, *keys)
    base = df.withColumn("__h", h).withColumn("__b", F.substring("__h", 1, digits))
    skey = [F.coalesce(F.col(s).cast("string"), F.lit("\u0000null")).alias(f"__s{i}") for i, s in enumerate(strata)]
    base = base.select("*", *skey)
    sk = [f"__s{i}" for i in range(len(strata))]
    counts = base.groupBy(*sk, "__b").agg(F.count(F.lit(1)).alias("__c"))
    if strata:
        w = Window.partitionBy(*sk).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(*sk, "__b", F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__off"),
                                F.sum("__c").over(Window.partitionBy(*sk)).alias("__n"))
    else:
        # two levels: buckets within a coarse one, and at most 256 coarse ones before it
        coarse = counts.withColumn("__g", F.substring("__b", 1, 2))
        before = prefix_offsets(coarse.groupBy("__g").agg(F.sum("__c").alias("__c")), "__g", ["__c"])
        w = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (coarse.withColumn("__in", F.coalesce(F.sum("__c").over(w), F.lit(0))).join(before, "__g")
                   .select("__b", (F.col("__in") + F.col("__o___c")).alias("__off"), F.lit(n_rows).cast("long").alias("__n")))
    # the ranks below need the rows by bucket anyway, so this join adds no shuffle of them
    ranked = base.join(offsets, sk + ["__b"])
    wr = Window.partitionBy(*sk, "__b").orderBy("__h", *keys)
    return ranked.withColumn("__rank", F.col("__off") + F.row_number().over(wr)) \
                 .drop("__off", "__b", "__h", *sk)


def train_test_split(df: DataFrame, key, test_size: float = 0.2, stratify: str | None = None,
                     seed: int = DEFAULT_SEED, exact: bool = True, n_rows: int | None = None) -> DataFrame:
    """Adds ``split`` ('train' / 'test').

    ``exact=True``: per stratum exactly ``floor(test_size * n_stratum)`` test rows,
    the lowest in hash order. ``exact=False``: each row independently by its
    hash (no shuffle at all; sizes exact only in expectation).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not exact:
        u = hash_unit(seed, *keys)
        return df.withColumn("split", F.when(u < test_size, "test").otherwise("train"))
    r = hash_rank(df, keys, stratify, seed, n_rows)
    is_test = F.col("__rank") <= F.floor(F.lit(test_size) * F.col("__n"))
    return r.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("__rank", "__n")


def kfold(df: DataFrame, key, k: int = 5, stratify: str | None = None, seed: int = DEFAULT_SEED,
          n_rows: int | None = None) -> DataFrame:
    """Adds integer ``fold`` in [0, k): rank in hash order modulo k, per stratum.

    Every stratum is spread evenly over the folds (sizes differ by at most one).
    """
    r = hash_rank(df, key, stratify, seed, n_rows)
    return r.withColumn("fold", F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int")).drop("__rank", "__n")


def kept(split: DataFrame, n_rows: int) -> DataFrame:
    """``split`` (or folds) of ``n_rows`` rows persisted, so that the jobs that read it do not
    rank the rows again, in partitions of no less than ``ROWS_A_PARTITION`` rows where there are
    so many: ranking leaves as many partitions as a shuffle has, and every job runs a task for each.
    The caller unpersists it."""
    return split.coalesce(max(1, math.ceil(n_rows / ROWS_A_PARTITION))).persist(StorageLevel.MEMORY_AND_DISK)
