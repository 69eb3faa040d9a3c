"""F21-F23 as Spark ML stages: one sparse feature vector, in a Pipeline or CrossValidator.

``TabularFeatures`` fits a ``FeaturePipeline`` on the rows it is given (so a
cross-validator fits it on each training part alone) and ``TabularFeaturesModel``
turns rows into one vector column. Encoded columns become positions, not columns:
a one-hot level or a hash bucket is one entry of the vector, so a hash into 100,000
buckets costs one number per row. Both stages are saved and loaded by Spark ML.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler, VectorSlicer
from pyspark.ml.param.shared import HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prep import FeaturePipeline, part_names, qcol

#: Key of the vector column's metadata that names its positions.
PARTS = "feature_parts"


class _Shared(HasOutputCol):
    config = Param(Params._dummy(), "config", "configuration of the preprocessing, as JSON", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "target column ('' for none)", TypeConverters.toString)
    ignored = Param(Params._dummy(), "ignored", "columns that are no features, such as keys and folds", TypeConverters.toListString)


def encoded(pipe: FeaturePipeline, df: DataFrame, output: str, keep=()) -> DataFrame:
    """``df`` with the fitted pipeline's features as one vector column ``output``.

    Values are those of ``FeaturePipeline.transform``; the columns in ``keep`` (of
    ``df``) stay beside it. Unseen and missing levels have no entry.
    """
    held = [c for c in keep if c != output]
    flat, parts = pipe.coded(df.select("*", *[qcol(c).alias(f"__keep{i}") for i, c in enumerate(held)]))
    plain = [p for p in parts if p["kind"] == "value"]
    wide = [p for p in parts if p["kind"] != "value" and p["size"]]
    x = flat.select(*[qcol(p["column"]).cast("double").alias(f"__v{i}") for i, p in enumerate(plain)],
                    *[qcol(p["column"]).cast("double").alias(f"__i{i}") for i, p in enumerate(wide)],
                    *[f"__keep{i}" for i in range(len(held))])
    if wide:
        # the encoder only needs to know the last position; what lies beyond has no entry
        last = x.sparkSession.createDataFrame([tuple(float(p["size"] - 1) for p in wide)],
                                              ", ".join(f"__i{i} double" for i in range(len(wide))))
        x = OneHotEncoder(inputCols=[f"__i{i}" for i in range(len(wide))], outputCols=[f"__w{i}" for i in range(len(wide))],
                          dropLast=True, handleInvalid="keep").fit(last).transform(x)
    vector = VectorAssembler(inputCols=[*(f"__v{i}" for i in range(len(plain))), *(f"__w{i}" for i in range(len(wide)))],
                             outputCol="__vector", handleInvalid="keep").transform(x)
    places, at = [], 0
    for p in plain + wide:
        size = p.get("size", 1)
        places.append({**p, "from": at, "size": size})
        at += size
    selected = pipe.state.get("selected_features")
    if selected is not None:
        at = {n: i for i, n in enumerate(position_names(places))}
        found = [c for c in selected if c in at]
        vector = VectorSlicer(inputCol="__vector", outputCol="__sliced", indices=[at[c] for c in found]).transform(vector)
        vector = vector.drop("__vector").withColumnRenamed("__sliced", "__vector")
        places = [{"column": c, "kind": "value", "from": i, "size": 1} for i, c in enumerate(found)]
    return vector.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(held)],
                         F.col("__vector").alias(output, metadata={PARTS: json.dumps(places)}))


def position_names(parts: list[dict]) -> list[str]:
    """The feature of every position, as ``FeaturePipeline.transform`` names its columns."""
    return [n for p in parts for n in part_names(p)]


def vector_parts(df: DataFrame, column: str) -> list[dict]:
    """[{column, kind, from, size[, levels]}] of a vector column made here."""
    return json.loads(df.schema[column].metadata[PARTS])


class TabularFeatures(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Typing, imputation, encoding and scaling, fitted on the rows given."""

    @keyword_only
    def __init__(self, *, config="{}", target="", ignored=(), outputCol="features"):
        super().__init__()
        self._setDefault(config="{}", target="", ignored=[], outputCol="features")
        given = dict(self._input_kwargs)
        if isinstance(given.get("config"), dict):
            given["config"] = json.dumps(given["config"])
        if "ignored" in given:
            given["ignored"] = list(given["ignored"])
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> "TabularFeaturesModel":
        target = self.getOrDefault(self.target) or None
        pipe = FeaturePipeline(json.loads(self.getOrDefault(self.config))).fit(
            dataset.drop(*self.getOrDefault(self.ignored)), target)
        model = TabularFeaturesModel()
        model._set(state=pipe.to_json(), config=self.getOrDefault(self.config), target=target or "",
                   ignored=self.getOrDefault(self.ignored), outputCol=self.getOutputCol())
        return model._resetUid(self.uid)


class TabularFeaturesModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Rows with their features as one vector; all input columns stay."""
    state = Param(Params._dummy(), "state", "the fitted preprocessing, as JSON", TypeConverters.toString)

    def pipeline(self) -> FeaturePipeline:
        return FeaturePipeline.from_json(self.getOrDefault(self.state))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return encoded(self.pipeline(), dataset, self.getOutputCol(), dataset.columns)
