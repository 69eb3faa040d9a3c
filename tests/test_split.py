"""Splits and folds (X1-X7), hashing (F9) and exact ranks."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabsmith.functions.exprs import md5_mod, seeded_hash
from tabsmith.operators import split as X


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(i, "abc"[i % 3] if i % 10 else "z") for i in range(5000)]
    return spark.createDataFrame(rows, "k bigint, s string")


def test_hash_rank_equals_row_number(keyed):
    import tabsmith.operators.split as S
    got = S.hash_rank(keyed, "k", "s", 42).select("k", "__rank", "__n")
    w = Window.partitionBy("s").orderBy(seeded_hash(42, "k"), "k")
    want = keyed.select("k", F.row_number().over(w).alias("__rank"),
                        F.count(F.lit(1)).over(Window.partitionBy("s")).alias("__n"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hash_rank_many_buckets(keyed):
    """Several buckets per stratum (small bucket size) still give exact ranks."""
    old = X._bucket_bits
    try:
        X._bucket_bits = lambda n, rows_per_bucket=50: 2
        got = X.hash_rank(keyed, "k", "s", 7).select("k", "__rank")
    finally:
        X._bucket_bits = old
    w = Window.partitionBy("s").orderBy(seeded_hash(7, "k"), "k")
    want = keyed.select("k", F.row_number().over(w).alias("__rank"))
    assert got.exceptAll(want).count() == 0


def test_stratified_split_sizes(keyed):
    out = X.train_test_split(keyed, "k", 0.2, stratify="s")
    sizes = {(r["s"], r["split"]): r["count"] for r in out.groupBy("s", "split").count().collect()}
    for s in "abcz":
        total = sizes.get((s, "test"), 0) + sizes.get((s, "train"), 0)
        assert sizes.get((s, "test"), 0) == int(0.2 * total)


def test_split_is_repeatable(keyed):
    a = X.train_test_split(keyed, "k", 0.2, stratify="s").where("split = 'test'").select("k")
    b = X.train_test_split(keyed, "k", 0.2, stratify="s").where("split = 'test'").select("k")
    assert a.exceptAll(b).count() == 0


def test_random_split_fraction(keyed):
    out = X.train_test_split(keyed, "k", 0.2, exact=False)
    share = out.where("split = 'test'").count() / 5000
    assert 0.17 < share < 0.23


def test_kfold_balanced(keyed):
    out = X.kfold(keyed, "k", 5, stratify="s")
    counts = {(r["s"], r["fold"]): r["count"] for r in out.groupBy("s", "fold").count().collect()}
    for s in "abcz":
        vals = [counts.get((s, f), 0) for f in range(5)]
        assert max(vals) - min(vals) <= 1


def test_sample_exact_size(keyed):
    assert X.sample_n(keyed, 123, "k").count() == 123
    assert X.sample_n(keyed, 10_000, "k").count() == 5000


def test_project_features(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = X.project_features(df, ["b", "missing"]).collect()[0]
    assert out.asDict() == {"b": 2, "missing": 0}


def test_binarise(spark):
    df = spark.createDataFrame([(0,), (2,), (None,), (1,)], "t int")
    assert [r["t"] for r in X.prepare(df, "t", binarise=True).collect()] == [0, 1, 0, 1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=8), st.sampled_from([2, 7, 8, 32, 1000, 65537]))
def test_md5_mod_matches_python(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r["b"] for r in df.select(md5_mod(F.col("v"), n).alias("b")).collect()]
    want = [int(hashlib.md5(v.encode()).hexdigest(), 16) % n for v in values]
    assert got == want


def test_folds_and_splits_are_kept_in_partitions_of_many_rows(spark):
    from tabsmith.operators import split as S
    from tabsmith.operators import tune as H
    df = spark.range(400).selectExpr("id", "CAST(id % 7 AS double) AS x", "CAST(id % 2 AS int) AS y")
    ctx = H.prepare_search(df, "y", "id", cv=2)
    try:
        assert ctx["folded"].is_cached and ctx["folded"].rdd.getNumPartitions() == 1
        assert ctx["folded"].groupBy("fold", "y").count().count() == 4
    finally:
        H.release_search(ctx)
    folds = S.kept(S.kfold(df, "id", 4, n_rows=400), 2 * S.ROWS_A_PARTITION + 1)
    assert folds.is_cached and folds.rdd.getNumPartitions() == 3 and folds.count() == 400
    folds.unpersist()
