"""Sources and sinks (S1-S10) and the streaming transform."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabsmith.operators.prep import FeaturePipeline
from tabsmith.sources import io as S
from tabsmith.streaming.scoring import file_stream, run_to_table, transform_stream


def test_csv_tokens_then_typing(spark):
    d = tempfile.mkdtemp(prefix="tabsmith-test-")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("x,y,z,w\n1,?,a,-9\n2,3.5,n/a,4\n?,4.5,b,5\n")
    with open(os.path.join(d, "c.csv"), "w") as f:
        f.write("q\n1\n")
    df = S.read_csv(spark, d, na_values=[-9])           # first file by name: b.csv
    types = dict(df.dtypes)
    assert types == {"x": "bigint", "y": "double", "z": "string", "w": "bigint"}
    rows = df.orderBy(F.col("y").asc_nulls_first()).collect()
    assert rows[0]["y"] is None and rows[0]["w"] is None
    assert sum(r["z"] is None for r in rows) == 1


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        S.read_csv(spark, "/nonexistent/path.csv")
    with pytest.raises(FileNotFoundError):
        S.resolve_csv_path(spark, tempfile.mkdtemp(prefix="tabsmith-empty-"))


def test_csv_folder_of_part_files_is_one_table(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tabsmith-test-"), "t")
    S.write_table(spark.range(100).repartition(7), d, fmt="csv")
    assert S.read_csv(spark, d).count() == 100
    assert S.read_csv_plain(spark, d).count() == 100


@pytest.mark.parametrize("config", [
    {"hashing_dim": 8}, {}, {"scaler": "minmax", "feature_selection": {"variance_threshold": 0.1, "correlation_threshold": 0.9}},
    {"feature_selection": {"selected_features": ["x", "c__a"]}}])
def test_reloaded_pipeline_is_the_same(spark, config):
    df = spark.createDataFrame([(float(i), 2.0 * i, "abc"[i % 3], f"2020-01-{1 + i % 28:02d}", i) for i in range(60)],
                               "x double, y double, c string, t string, n long")
    p = FeaturePipeline(config).fit(df)
    d = tempfile.mkdtemp(prefix="tabsmith-test-")
    S.save_pipeline(p, os.path.join(d, "p"))
    q = S.load_pipeline(spark, os.path.join(d, "p"))
    a, b = p.transform(df), q.transform(df)
    assert a.dtypes == b.dtypes and q.feature_names() == p.feature_names() and q.config == p.config
    assert sorted(a.collect()) == sorted(b.collect())


def test_model_reloads_by_its_own_class(spark):
    from tabsmith.operators import train as M
    df = spark.createDataFrame([(float(i % 17), float(i % 5), int(i % 17 > 8)) for i in range(200)], "x double, z double, y int")
    pipe, model, feats = M.fit_full(df, "y", "logistic_regression", {})
    path = os.path.join(tempfile.mkdtemp(prefix="tabsmith-test-"), "m")
    S.save_model(model, path)
    again = S.load_model(spark, path)
    assert type(again) is type(model) and again.coefficients == model.coefficients
    x = M.assemble(pipe.transform(df), feats, "y")
    a, b = (M.score_frame(m, x, "classification").select("p1").collect() for m in (model, again))
    assert a == b


@pytest.mark.parametrize("parts", [1, 5])
def test_streaming_transform_equals_batch(spark, parts):
    d = os.path.join(tempfile.mkdtemp(prefix="tabsmith-test-"), "events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(parts).write.parquet(d)
    batch = spark.read.parquet(d)
    p = FeaturePipeline({"hashing_dim": 8}).fit(batch.drop("event_id"))
    got = run_to_table(transform_stream(p, file_stream(spark, d, batch.schema)))
    want = p.transform(batch)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_json_report(spark):
    d = tempfile.mkdtemp(prefix="tabsmith-test-")
    S.save_json_report(spark, {"roc_auc": 0.8, "f1": 0.7, "log_loss": None}, os.path.join(d, "r"))
    m = spark.read.json(os.path.join(d, "r")).first()["metrics"]
    assert m["roc_auc"] == 0.8 and m["f1"] == 0.7


def test_shapes_let_every_date_through(spark):
    values = ["2020-01-31", "+12020-01-31", "-2020-01-31", "31.01.2020", "31.02.2020", "01.01.2020 23:59", "01.01.2020 24:00", "12/31/2020",
              "31/12/2020", "2020-01-31T10:00:59", "2020-01-31t10:00:59", "2020-01-31 10:00:60", "20200131", "2020131", "1/2/2020", "2020/02/30",
              "01-01-2020", "x", "", "2020-01-31 ", "\u0662020-01-01", None]
    formats = [*S.DATE_FORMATS, "d/M/yyyy", "yyyy-MM-dd[ HH:mm]"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    both = df.select(*[c for i, f in enumerate(formats) for c in (
        F.try_to_timestamp(F.trim("t"), F.lit(f)).cast("string").alias(f"a{i}"), S._parsed(F.trim("t"), f).cast("string").alias(f"b{i}"))]).collect()
    for i, f in enumerate(formats):
        assert [r[f"a{i}"] for r in both] == [r[f"b{i}"] for r in both], f
    assert S.format_shape("d/M/yyyy") is None
    plan = S._parsed(F.col("t"), "dd.MM.yyyy")
    assert "RLIKE" in str(plan).upper()         # other shapes never reach the parser


def test_number_like_texts_hold_every_double(spark):
    values = ["1", " 1 ", "+1.", "-.5", "1e5", "1.E-5", "1f", "2D", "0x1.8p3", "Infinity", "-inf", "+INF", "NaN", "nan", "1_0", "1.2.3", "31.01.2020",
              "e5", "", ".", "+", "abc", "1 2", "\t7\n", "\u0661", None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    rows = df.select("t", F.col("t").try_cast("double").isNotNull().alias("d"), F.col("t").rlike(S.NUMBER_LIKE).alias("like")).collect()
    assert all(r["like"] for r in rows if r["d"])
    assert not any(r["like"] for r in rows if r["t"] in ("1.2.3", "31.01.2020", "abc"))
