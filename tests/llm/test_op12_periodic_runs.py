import hashlib
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tabsmith.llm import op12_periodic_runs as op


def by_definition(words):
    """Every (start, length, period) by trying all periods and stretches."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q) and not any(
                    all(words[k] == words[k + d] for k in range(s, e - d)) for d in range(1, q)):
                out.append((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def rewritten(key, words):
    h = zlib.crc32(str(key).encode())
    n = len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(key, text):
    words = rewritten(key, (text or "").encode().split())
    runs = by_definition(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (key, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
ordered = lambda rows: sorted(rows, key=repr)


@pytest.mark.parametrize("seed", range(60))
def test_scan_and_splitting_match_the_definition(seed):
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(int(rng.integers(1, 8))):
        root = rng.integers(0, int(rng.integers(1, 5)) + 1, int(rng.integers(1, 9)))
        parts.append(np.tile(root, int(rng.integers(1, 8)))[: int(rng.integers(1, 60))])
        parts.append(rng.integers(0, 3 + seed % 40, int(rng.integers(0, 12))))
    words = np.concatenate(parts)
    want = by_definition(words.tolist())
    assert op.scan(words) == want
    text = " ".join(map(str, words))
    [(_, got)] = op.runs_of([text], [None])
    assert got == want


def test_splitting_keeps_documents_apart():
    got = [r for _, r in op.runs_of(["a b a b a b", "a b a b", "", "x x x x x x"], [None] * 4)]
    assert got == [[], [], [], [(0, 6, 1)]]


def test_small_table_by_definition(spark, small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect() if len((r.text or "").split()) < 700]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    got = op.periodic_runs(some, rewrite=True).select(COLUMNS).collect()
    want = [expected(*r) for r in rows]
    assert ordered(map(tuple, got)) == ordered(want)
    assert sum(w[1] for w in want) > 5


def test_odd_rows(spark):
    data = [(1, None, 0), (2, "", 0), (None, "a a a a a a", 0), (None, None, 0), (3, "x y x y x y x y", 1), (3, "x y x y x y x y", 1),
            (4, "a a a a a b b b b b b a a a a a a a", 2), (5, "é é é é é é é é é é é é", 3),
            (6, " \t\n ", 0), (7, "a a a a a", 4), (8, "a b a b a b a", 4), (12, "one", 1), (29, "u v w", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, start int").withColumnRenamed("start", "n_runs")
    got = op.periodic_runs(docs, rewrite=True).select(COLUMNS).collect()
    assert ordered(map(tuple, got)) == ordered(expected(k, t) for k, t, _ in data)


def test_empty_table_and_text(spark, docs_of):
    out = op.periodic_runs(docs_of([]), with_text=True)
    assert out.collect() == [] and out.columns[0] == "doc_id"
    r = op.periodic_runs(docs_of([(5, "so so so so so so it is")]), with_text=True).first()
    assert r.collapsed == "so it is" and [tuple(x) for x in r.runs] == [(0, 6, 1)]


@pytest.mark.parametrize("words", [["w"], ["a", "b"], [str(i) for i in range(30_000)]], ids=["one", "two", "long"])
def test_very_long_texts_take_no_square(words):
    took = []
    for n in (100_000, 400_000):
        text = " ".join((words * (n // len(words) + 1))[:n])
        began = time.perf_counter()
        [(_, got)] = op.runs_of([text], [None])
        took.append(time.perf_counter() - began)
        want = [(0, n, len(words))] if n >= 4 * len(words) else []
        assert got == want
    assert took[1] < 12 * took[0] + 1
