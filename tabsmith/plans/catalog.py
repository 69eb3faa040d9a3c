"""Query catalog: named Spark plans over the input tables, each with an
equivalent DuckDB SQL text where one exists (the correctness oracle).

Conventions shared by both sides:
* every computed column is aliased to the same name;
* floating results are rounded as ``floor(x * 1e8 + 0.5) / 1e8`` — the same
  IEEE arithmetic in both engines, so equal inputs give equal outputs;
* no timestamp columns in results (time zones differ between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc
from ..sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    """Decorator: add a query (and its oracle SQL) to the catalog."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        if headline:
            HEADLINE.append(name)
        return run
    return deco


def R(c, digits: int = 8) -> Column:
    """Rounding to ``digits`` places, written so both engines compute the same double.

    Eight places: means of 2-decimal data over n rows terminate within
    2 + log2(n) places, so ties at the rounding position do not occur, while
    summation-order noise stays far below the last kept place.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.floor(c.cast("double") * scale + 0.5) / scale


def r(expr: str, digits: int = 8) -> str:
    """SQL twin of ``R``."""
    return f"(floor(({expr}) * 1e{digits} + 0.5) / 1e{digits})"


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


# --------------------------------------------------------------------------
# Derived fixtures (see FIXTURES.md §3), each with its SQL twin
# --------------------------------------------------------------------------

MIX_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_linestatus", "l_shipdate"]


def mix(spark, sf_dir) -> DataFrame:
    """D-MIX: lineitem with the target ``is_returned = (l_returnflag = 'R')``."""
    li = T(spark, sf_dir, "lineitem")
    return li.select(*MIX_COLS, (F.col("l_returnflag") == "R").cast("int").alias("is_returned"))


MIX_SQL = ("(SELECT " + ", ".join(MIX_COLS) +
           ", CAST(l_returnflag = 'R' AS INTEGER) AS is_returned FROM lineitem)")


def docs_labels(spark, sf_dir) -> DataFrame:
    """D-NULL: documents LEFT JOIN labels (labels cover part of the documents)."""
    d = T(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = T(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


DOCS_SQL = ("(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
            "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")


def lineitem_nulls(spark, sf_dir) -> DataFrame:
    """D-NULL (injected): NULL discounts where 0 and NULL line status where 'F'."""
    li = T(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     F.expr("nullif(l_discount, 0.0)").alias("l_discount"),
                     F.expr("nullif(l_linestatus, 'F')").alias("l_linestatus"),
                     "l_returnflag", "l_tax")


LINEITEM_NULLS_SQL = ("(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, "
                      "nullif(l_discount, 0.0) AS l_discount, nullif(l_linestatus, 'F') AS l_linestatus, "
                      "l_returnflag, l_tax FROM lineitem)")


def scored(spark, sf_dir) -> DataFrame:
    """D-SCORE: fixed score ``l_quantity / 50`` against ``l_returnflag = 'R'``."""
    li = T(spark, sf_dir, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("y"),
                     (F.col("l_quantity") / 50.0).alias("p"))


SCORED_SQL = "(SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity / 50.0 AS p FROM lineitem)"
