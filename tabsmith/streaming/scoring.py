"""Fitted preprocessing and models applied to streaming DataFrames.

A fitted ``FeaturePipeline`` is a single projection with literal parameters
and a Spark ML model's ``transform`` is row-wise, so both run unchanged on a
``readStream`` source: no state, no watermark, any output mode. Fitting stays
a batch job on a bounded training table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.prep import FeaturePipeline
from ..operators.train import assemble, score_frame
from ..session import checkpoint_dir


def transform_stream(pipeline: FeaturePipeline, stream: DataFrame) -> DataFrame:
    """F22 on a stream (stateless projection)."""
    return pipeline.transform(stream)


def score_stream(pipeline: FeaturePipeline, model, features, stream: DataFrame, target: str | None = None,
                 task: str = "classification") -> DataFrame:
    """M14 on a stream: transform, assemble, predict."""
    x = pipeline.transform(stream)
    if target is None or target not in x.columns:
        from pyspark.sql import functions as F
        x = x.withColumn("__no_label", F.lit(None).cast("double"))
        target = "__no_label"
    return score_frame(model, assemble(x, features, target), task)


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table (one file, or a folder of part files) as a stream; a schema is
    required for streaming sources.

    The source takes a plain path for a folder and fails on a file; a pattern that
    matches only this path serves both.
    """
    path = path.rstrip("/")
    path = f"{path[:-1]}[{path[-1]}]"
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def run_to_table(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Drain a stream into a parquet table and return that table.

    Table and stream checkpoint lie under the session's shared folder, so no row
    passes through the driver and a restarted query goes on where it stopped.
    """
    spark = stream.sparkSession
    path = path or f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    q = (stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", f"{path}-state").start(f"{path}-rows"))
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}-rows")
