"""Sources and sinks.

CSV input is read in two phases: every column as a string, missing-value
tokens turned into NULL, and only then typed — a numeric column that uses
"?" for missing is still numeric. The typing decision is one aggregation of
``try_cast`` checks over all columns.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import kind_of, normalize_nans, qc

# String tokens read as missing in every data set (on top of the
# empty field).
DEFAULT_NA_VALUES = ["?", "name", "n/a", "N/A", "na", "NA", "none", "None", "missing"]
# Further tokens the usual CSV readers treat as missing by default.
STANDARD_NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                      "1.#IND", "1.#QNAN", "<NA>", "NULL", "NaN", "n/a", "nan", "null"]


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The ``*.csv`` files at ``path`` (a file or a folder), sorted; any store that Spark reads.

    Only names are listed: the binary source prunes the unread contents.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    try:
        names = [r["path"] for r in listing.load(path).select("path").collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"Nothing to read at {path}") from e
    if not names:
        raise FileNotFoundError(f"{path} holds no CSV file")
    return sorted(names)


def resolve_csv_path(spark: SparkSession, path: str) -> list[str]:
    """The files that make up one CSV table.

    A named file is itself. A folder of part files, as a distributed writer
    leaves them, is one table of all its parts. Of any other folder the first
    file by name is read.
    """
    files = csv_files(spark, path)
    parts = [f for f in files if f.rsplit("/", 1)[-1].startswith("part-")]
    return parts or files[:1]


def na_tokens(extra=None) -> list[str]:
    """The full token list (defaults + standard + dataset sentinels as text)."""
    toks = list(dict.fromkeys(DEFAULT_NA_VALUES + STANDARD_NA_VALUES))
    for v in extra or []:
        toks.append(str(v))
        if isinstance(v, (int, float)) and float(v) == int(v):
            toks.append(f"{float(v)}")  # -9 also matches "-9.0"
    return list(dict.fromkeys(toks))


def replace_tokens(df: DataFrame, tokens, columns=None, sentinels=()) -> DataFrame:
    """S2 on a typed frame: string tokens → NULL in string columns, numeric
    sentinels → NULL in numeric columns, all in one projection."""
    cols = set(columns or df.columns)
    toks = list(tokens)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols and kind_of(f.dataType) == "string" and toks:
            c = F.when(F.trim(c).isin(toks), F.lit(None)).otherwise(c)
        elif f.name in cols and kind_of(f.dataType) == "numeric" and sentinels:
            c = F.when(c.isin([float(s) for s in sentinels]), F.lit(None)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


#: Every text that casts to a double matches this: decimal, hexadecimal, Infinity or NaN.
NUMBER_LIKE = r"(?i)^[\x00-\x20]*[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?[fd]?|0x[0-9a-fp.+-]+[fd]?|inf|infinity|nan)[\x00-\x20]*$"


def infer_types(df: DataFrame) -> dict[str, str]:
    """S3: the narrowest of bigint / double / boolean / string that every non-NULL
    value of a string column parses as (one aggregation); dates are ``with_dates``."""
    checks, names = [], []
    for f in df.schema.fields:
        if kind_of(f.dataType) != "string":
            continue
        c = F.col(f.name)
        names.append((f.name, "bigint"))
        checks.append(F.bool_and(c.try_cast("bigint").isNotNull() | c.isNull()))
        # a text that is no number costs an exception in the cast: only number-like ones get there
        names.append((f.name, "double"))
        checks.append(F.bool_and(F.when(c.rlike(NUMBER_LIKE), c.try_cast("double").isNotNull()).otherwise(c.isNull())))
        # only True/False spellings are booleans (not 1/0, which are integers above)
        names.append((f.name, "boolean"))
        checks.append(F.bool_and(F.lower(F.trim(c)).isin("true", "false") | c.isNull()))
        names.append((f.name, "_any"))
        checks.append(F.count(c) > 0)
    if not checks:
        return {}
    row = df.agg(*[x.alias(f"k{i}") for i, x in enumerate(checks)]).collect()[0]
    ok = {k: row[f"k{i}"] for i, k in enumerate(names)}
    out = {}
    for f in df.schema.fields:
        if kind_of(f.dataType) != "string":
            continue
        if not ok[(f.name, "_any")]:
            out[f.name] = "double"          # all missing: a float column of NaN
        elif ok[(f.name, "bigint")]:
            out[f.name] = "bigint"
        elif ok[(f.name, "double")]:
            out[f.name] = "double"
        elif ok[(f.name, "boolean")]:
            out[f.name] = "boolean"
        else:
            out[f.name] = "string"
    return out


#: Date formats that are tried for a column of text, in this order.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "dd.MM.yyyy", "dd.MM.yyyy HH:mm",
                "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "yyyyMMdd"]


#: What two letters of a pattern read, and nothing else.
_TWO_DIGITS = {"MM": "(0[1-9]|1[0-2])", "dd": "(0[1-9]|[12][0-9]|3[01])", "HH": "([01][0-9]|2[0-4])",
               "mm": "[0-5][0-9]", "ss": "[0-5][0-9]"}


def format_shape(fmt: str) -> str | None:
    """A regular expression that every text of the date format ``fmt`` matches; None where
    the format holds anything but years, two-letter fields, quoted text and punctuation.
    A text of another shape costs an exception in the parser, so shapes are tested first."""
    out = []
    for token in (m.group(0) for m in re.finditer(r"'[^']+'|([A-Za-z])\1*|.", fmt, re.S)):
        if token == "yyyy":
            out.append("[+-]?[0-9]{4,}")
        elif token in _TWO_DIGITS:
            out.append(_TWO_DIGITS[token])
        elif len(token) > 2 and token[0] == token[-1] == "'":
            out.append(re.escape(token[1:-1]))
        elif token in " /.:,_-":
            out.append(re.escape(token))
        else:
            return None
    return "(?iu)^" + "".join(out) + "$"


def _parsed(text, fmt: str):
    """``text`` as a timestamp of ``fmt``, NULL where it is none."""
    shape, value = format_shape(fmt), F.try_to_timestamp(text, F.lit(fmt))
    return F.when(text.rlike(shape), value) if shape else value


def date_formats(df: DataFrame, columns=None, formats=None) -> DataFrame:
    """``(column_name, n_nonnull, n_parsed, format, status)``, one row per text column.

    One aggregation counts what each column has in each format. The format that parses
    every value is the column's (status ``typed``); where several do, as with days that
    are all below 13, the first is named and the column is ``ambiguous``; where none
    does, ``n_parsed`` is what the best one parses and the column stays ``text``.
    """
    formats = list(formats or DATE_FORMATS)
    columns = [f.name for f in df.schema.fields if kind_of(f.dataType) == "string" and (columns is None or f.name in columns)]
    spark = df.sparkSession
    schema = "column_name string, n_nonnull long, n_parsed long, format string, status string"
    if not columns:
        return spark.createDataFrame([], schema)
    aggs = [a for c in columns for a in (F.count(qc(c)), *(F.count(_parsed(F.trim(qc(c)), f)) for f in formats))]
    one = df.agg(*[a.alias(f"k{i}") for i, a in enumerate(aggs)]).first()
    rows, width = [], len(formats) + 1
    for i, c in enumerate(columns):
        n, *parsed = one[i * width:(i + 1) * width]
        whole = [f for f, k in zip(formats, parsed) if n and k == n]
        rows.append((c, n, max(parsed), whole[0] if whole else None,
                     "text" if not whole else "typed" if len(whole) == 1 else "ambiguous"))
    return spark.createDataFrame(rows, schema)


def with_dates(df: DataFrame, columns=None, formats=None, prefer=()) -> DataFrame:
    """Text columns that are dates throughout, as timestamps. Ambiguous columns stay text
    unless a format in ``prefer`` (by order) parses them whole."""
    chosen = {}
    for r in date_formats(df, columns, formats).collect():          # one row per column
        if r["status"] == "typed":
            chosen[r["column_name"]] = r["format"]
        elif r["status"] == "ambiguous":
            whole = [p for p in date_formats(df, [r["column_name"]], prefer).collect() if p["format"]] if prefer else []
            if whole:
                chosen[r["column_name"]] = whole[0]["format"]
    return df.select(*[_parsed(F.trim(qc(c)), chosen[c]).alias(c) if c in chosen else qc(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str, na_values=None, dates: bool = False, formats=None, prefer=()) -> DataFrame:
    """Tokens to NULL first, then typing; with ``dates`` also the columns that hold
    dates of one format (``with_dates``)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(resolve_csv_path(spark, path))
    cleaned = replace_tokens(raw, na_tokens(na_values))
    types = infer_types(cleaned)
    out = cleaned.select(*[
        (F.col(c).try_cast(types[c]) if types.get(c, "string") != "string" else F.col(c)).alias(c)
        for c in cleaned.columns])
    out = with_dates(out, formats=formats, prefer=prefer) if dates else out
    return normalize_nans(out)


def read_csv_plain(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred schema; error when absent."""
    return spark.read.option("header", True).option("inferSchema", True).csv(resolve_csv_path(spark, path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Overwrite a table (parquet by default; csv with header)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Re-read a staged table."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(fmt).load(path)


def save_pipeline(pipeline, path: str) -> None:
    """Fitted preprocessing (state and configuration) as a JSON parameter table."""
    spark = SparkSession.getActiveSession()
    pipeline.parameter_table(spark).coalesce(1).write.mode("overwrite").json(path)


def load_pipeline(spark: SparkSession, path: str):
    """The fitted pipeline of a saved parameter table; nothing else is needed."""
    from ..operators.prep import FeaturePipeline
    return FeaturePipeline.from_parameter_table(spark.read.json(path))


def save_model(model, path: str) -> None:
    """A fitted Spark ML model / PipelineModel."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """A saved Spark ML model of whatever class its metadata name."""
    from pyspark.ml.util import DefaultParamsReader
    return DefaultParamsReader.loadParamsInstance(path, spark)


def save_json_report(spark: SparkSession, metrics: dict, path: str) -> DataFrame:
    """One-row report (time stamp, and a struct of the metrics) written as JSON."""
    fields = ", ".join(f"`{k}`: double" for k in metrics)
    values = tuple(None if v is None else float(v) for v in metrics.values())
    df = spark.createDataFrame([(datetime.now(timezone.utc).isoformat(), values)],
                               f"generated_at string, metrics struct<{fields}>")
    df.coalesce(1).write.mode("overwrite").json(path)
    return df
