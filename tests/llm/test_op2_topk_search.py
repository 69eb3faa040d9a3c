import math
import random

import pytest

from tabsmith.llm import op2_topk_search as op


def brute(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 100 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in ok if j != q)[:k]
            out += [(q, n + 1, j, -t) for n, (t, j) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query_id string")
    v = op.quantised(df)
    return sorted(map(tuple, op.top_k(v, v.where("vec_id % 100 = 0"), k).collect()))


def test_matches_brute_force_with_ties(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [float(rng.choice([-2, -1, 0, 1, 0.5])) for _ in range(8)], "x") for i in range(0, 900, 3)]
    assert run(spark, rows) == brute([r[:2] for r in rows], 10)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0], "a"), (100, None, "a"), (1, [float("nan"), 1.0], None), (2, [float("inf"), 1.0], None),
            (3, [None, 1.0], None), (4, [1.0], None), (5, [], None), (None, [1.0, 1.0], None), (200, [-1.0, 0.25], None)]
    assert run(spark, rows) == brute([r[:2] for r in rows], 10)


def by_row(rows, k):
    """Every row but the query's own is a candidate; equal query rows are asked once."""
    v = [(i, [math.floor(1024 * x) for x in t]) for i, t in rows]
    out = set()
    for n, (q, a) in enumerate(v):
        if q % 100 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), j) for m, (j, b) in enumerate(v) if m != n)[:k]
            out |= {(q, tuple(a), r + 1, j, -t) for r, (t, j) in enumerate(s)}
    return sorted((q, r, j, t) for q, _, r, j, t in out)


def test_repeated_rows_and_ids(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [0.5, 0.0]), (100, [-1.0, 3.0]), (100, [-1.0, 3.0]), (200, [0.0, 0.0]), (200, [0.0])]
    rows += [(rng.choice([0, 7, 300, i]), [rng.choice([-1.0, 0.0, 2.0]) for _ in range(2)]) for i in range(1, 60)]
    rows = [(i, v + [0.0] * (2 - len(v))) for i, v in rows]
    for shard in (16_384, 5):
        monkeypatch.setattr(op, "SHARD_VECTORS", shard)
        for k in (1, 3, 200):
            assert run(spark, [(*r, "x") for r in rows], k) == by_row(rows, k)


def test_very_long_vectors_and_large_scores(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randrange(-9, 10)) for _ in range(rng.choice([3, 20_000]))]) for i in range(0, 300, 50)]
    assert run(spark, [(*r, "x") for r in rows]) == brute(rows, 10)
    big = [(i, [float(rng.randrange(1 << 19, 1 << 20)), float(i)]) for i in range(0, 300, 25)]       # beyond exact floats
    assert run(spark, [(*r, "x") for r in big]) == brute(big, 10)
    for value in (1e9, 1e17):
        with pytest.raises(Exception, match="64 bits"):
            run(spark, [(0, [value, 1.0], "x"), (1, [value, 2.0], "x")])


def test_empty_table(spark):
    assert run(spark, []) == []


def test_pruned_search_is_exact():
    import numpy as np
    rng = np.random.default_rng(1)
    vectors = np.floor(rng.normal(0, 300, (20_000, 24)) * np.exp(-np.arange(24) / 3))
    shard = op.Shard(np.arange(20_000), vectors)
    for q in (0, 77, 19_999):
        ids, scores = shard.best(vectors[q], 10)
        full = vectors @ vectors[q]
        want = np.lexsort((np.arange(20_000), -full))[:10]
        assert (ids == want).all() and (scores == full[want]).all()
