"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes a DataFrame (or a ``SparkSession``) and stays lazy. These helpers exist
for tests, ``bench.py`` and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on for exact, engine-independent results.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # one-pass profiles and pair statistics aggregate hundreds of buffer fields;
    # keep them in whole-stage code generation
    "spark.sql.codegen.maxFields": "2000",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tabsmith", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    master = master or os.environ.get("TABSMITH_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TABSMITH_DRIVER_MEMORY", "16g"))
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone; date parts of TIMESTAMP columns depend on it."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage; it is an error if it is
    unset there. In local mode (tests) a fresh folder is taken and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set; it must name shared storage")
        conf_dir = tempfile.mkdtemp(prefix="tabsmith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir
