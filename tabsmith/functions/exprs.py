"""Column-expression helpers shared by the operators.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation; none of it is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DATETIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def qc(name: str) -> Column:
    """Column by exact name (dots, spaces and back-ticks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def kind_of(dtype: T.DataType) -> str:
    """Coarse storage kind: numeric, boolean, datetime, string or other."""
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dtype, DATETIME_TYPES):
        return "datetime"
    if isinstance(dtype, T.StringType):
        return "string"
    return "other"


def field_kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: kind_of(f.dataType) for f in df.schema.fields}


def is_float_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def nan_to_null(c: Column) -> Column:
    """NaN becomes NULL: Spark counts NaN as a value, the tabular model does not."""
    return F.nanvl(c, F.lit(None).cast("double"))


def normalize_nans(df: DataFrame) -> DataFrame:
    """One projection turning every float NaN into NULL (ingest rule)."""
    cols = []
    for f in df.schema.fields:
        if is_float_type(f.dataType):
            cols.append(F.nanvl(qc(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(qc(f.name))
    return df.select(*cols)


def as_number(c: Column, dtype: T.DataType) -> Column:
    """Numeric view of a numeric/boolean column as double (booleans → 0/1)."""
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("double")


def safe_timestamp(c: Column, formats: list[str] | None = None) -> Column:
    """Parse a string as a timestamp; bad values become NULL (never an error).

    Digit-only strings such as ``'2020'`` or ``'17'`` are not treated as dates
    (Spark would accept a bare year).
    """
    s = F.trim(c.cast("string"))
    parsed = [F.try_to_timestamp(s)]
    for fmt in formats or []:
        parsed.append(F.try_to_timestamp(s, F.lit(fmt)))
    value = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    return F.when(s.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), F.lit(None)).otherwise(value)


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL (not an ANSI
    division error) when either side is constant."""
    both = a.isNotNull() & b.isNotNull()
    aa, bb = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(aa, bb), F.stddev_samp(aa) * F.stddev_samp(bb))


def with_counts_below(df: DataFrame, specs: dict) -> DataFrame:
    """Add integer columns ``name = number of edges strictly below x`` for
    ``specs = {name: (x_column, sorted_edges)}`` using Spark ML's Bucketizer
    (a JVM binary search per value). Duplicate edges are handled by a
    multiplicity table; NULL x gives NULL.
    """
    from pyspark.ml.feature import Bucketizer
    if not specs:
        return df
    tmp_in, tmp_out, splits_arr, maps = [], [], [], {}
    base = df
    for k, (name, (x, edges)) in enumerate(specs.items()):
        uniq = sorted(set(float(e) for e in edges))
        counts = [sum(1 for e in edges if float(e) == u) for u in uniq]
        cum = [0]
        for c in counts:
            cum.append(cum[-1] + c)                    # cum[t] = edges among the t smallest unique
        neg = [-u for u in reversed(uniq)]
        splits_arr.append([float("-inf")] + neg + [float("inf")])
        base = base.withColumn(f"__bin_in{k}", -x.cast("double"))
        tmp_in.append(f"__bin_in{k}")
        tmp_out.append(f"__bin_out{k}")
        maps[name] = (k, len(uniq), cum, x)
    b = Bucketizer(splitsArray=splits_arr, inputCols=tmp_in, outputCols=tmp_out, handleInvalid="keep")
    out = b.transform(base)
    for name, (k, m, cum, x) in maps.items():
        # bucket j of -x: j unique edges u satisfy -u <= -x, i.e. u >= x; so m - j unique edges are below x
        below_unique = F.lit(m) - F.col(f"__bin_out{k}").cast("int")
        val = F.element_at(F.array(*[F.lit(c) for c in cum]), below_unique + 1)
        out = out.withColumn(name, F.when(x.isNotNull(), val))
    return out.drop(*tmp_in, *tmp_out)


def hex_piece(h: Column, i: int) -> Column:
    """The i-th 32-bit piece (8 hex digits) of an md5 hex digest, as bigint."""
    return F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")


def md5_mod(value: Column, n: int) -> Column:
    """``int(md5(str(value)), 16) % n`` computed exactly with built-ins.

    The 128-bit digest is reduced piece by piece (Horner's rule modulo n with
    base 2^32), so intermediate values stay below n * 2^32 and fit a long for
    n up to 2^31.
    """
    if n <= 0 or n >= 2 ** 31:
        raise ValueError("n must be in [1, 2^31)")
    h = F.md5(value.cast("string"))
    base = (2 ** 32) % n
    acc = F.lit(0).cast("long")
    for i in range(4):
        acc = F.pmod(acc * F.lit(base) + F.pmod(hex_piece(h, i), F.lit(n)), F.lit(n))
    return acc


def seeded_hash(seed: int, *cols: str | Column) -> Column:
    """Repeatable pseudo-random order key: md5 of ``seed|k1|k2…`` (hex string)."""
    parts = [F.lit(str(seed))] + [
        (qc(c) if isinstance(c, str) else c).cast("string") for c in cols
    ]
    return F.md5(F.concat_ws("|", *parts))


def hash_unit(seed: int, *cols: str | Column) -> Column:
    """Deterministic value in [0, 1) from the first 52 bits of ``seeded_hash``."""
    h = seeded_hash(seed, *cols)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))
