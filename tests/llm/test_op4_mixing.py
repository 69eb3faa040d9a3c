import hashlib
import math
from collections import Counter

from tabsmith.llm import op4_mixing as op


def poisson(seed, key, rate):
    u = (int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
    n, p, total = 0, math.exp(-rate), 0.0
    while True:
        total += p
        if total > u:
            return n
        n += 1
        p *= rate / n


def test_draws_match_the_inverted_distribution(spark, docs_of):
    rows = [(i, f"t{i}", "abc"[min(2, i % 5)]) for i in range(500)]
    docs = docs_of(rows)
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "source string, weight double")
    got = Counter(r.doc_id for r in op.mixed(docs, weights).collect())
    size = Counter(r[2] for r in rows)
    rate = {s: w * 500 / size[s] for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.2))}
    assert got == Counter({k: n for k, _, s in rows if (n := poisson("mix", k, rate[s]))})


def test_copies_follow_the_rate_and_are_shuffled(spark, docs_of):
    docs = docs_of([(i, "x", "big" if i % 4 else "rare") for i in range(4000)])
    weights = spark.createDataFrame([("big", 0.5), ("rare", 0.5)], "source string, weight double")
    rows = op.mixed(docs, weights, partitions=1).collect()
    n = Counter(r.source for r in rows)
    assert abs(n["rare"] - 2000) < 200 and abs(n["big"] - 2000) < 200
    order = [r.doc_id for r in rows]
    assert order != sorted(order) and [r.source for r in rows[:200]].count("rare") > 60
    assert all(1 <= r.copy <= r.n_copies for r in rows)


def test_odd_rows(spark, docs_of):
    docs = docs_of([(1, "a", "s"), (1, "a", "s"), (2, None, None), (None, "b", "s"), (3, "", "none"), (4, "x", "zero")])
    weights = spark.createDataFrame([("s", 40.0), (None, 40.0), ("zero", 0.0)], "source string, weight double")
    rows = op.mixed(docs.withColumnRenamed("lang", "copy"), weights).collect()
    keys = Counter(r.doc_id for r in rows)
    assert keys[3] == keys[4] == 0 and keys[2] > 0 and keys[1] % 2 == 0 and keys[None] > 0
    assert op.mixed(docs_of([]), weights).collect() == []


def test_a_very_large_rate(spark, docs_of):
    docs = docs_of([(i, "x", "one" if i == 0 else "rest") for i in range(2000)])
    weights = spark.createDataFrame([("one", 1.0), ("rest", 0.0)], "source string, weight double")
    assert abs(op.mixed(docs, weights).count() - 2000) < 300


def test_sources_beyond_the_broadcast_bound(spark, docs_of, monkeypatch):
    docs = docs_of([(i, "x", f"s{i % 7}") for i in range(200)])
    want = sorted(map(tuple, op.mixed(docs, op.tempered_weights(docs)).collect()))
    monkeypatch.setattr(op, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, op.mixed(docs, op.tempered_weights(docs)).collect())) == want
