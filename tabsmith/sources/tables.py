"""Reading the input tables (parquet)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``<sf_dir>/<name>.parquet``, a file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views named like the tables, for ``spark.sql`` use."""
    for n in names:
        if os.path.exists(os.path.join(sf_dir, f"{n}.parquet")):
            spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet")).createOrReplaceTempView(n)
