import math
import zlib

import numpy as np
import pytest

from tabsmith.llm import op10_quality as op
from tabsmith.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    out = op.quality(table(spark, sf, "documents"), labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted for r in out if r.quality]) >= 0.97
    assert np.mean([r.predicted for r in out if not r.quality]) <= 0.35


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = op.AdditiveModel(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93


def test_trees_cut_where_the_sums_change():
    leaf = op.best_cuts(np.array([5.0, 5, -5, -5, 1, 1]), np.ones(6), 2)
    assert leaf[0] == leaf[1] > 0 > leaf[2] == leaf[3] and leaf[4] == leaf[5]
    gain, table_ = op.best_quarters(np.array([[4.0, -4], [-4, 4]]), np.ones((2, 2)))
    assert gain > 0 and (np.sign(table_) == [[1, -1], [-1, 1]]).all()


def test_odd_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (2, ""), (None, "a"), (3, "word " * 50_000)]).withColumnRenamed("lang", "score")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    rows = op.quality(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in op.quality(docs, none).collect()} == {0.5}
    assert op.quality(docs_of([]), labels).collect() == []


def plain_features(text):
    """The same measures, character by character and word by word."""
    data = (text or "").encode()
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    is_letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    stops = b".,;:?'\"()-"
    is_mark = lambda b: not (is_letter(b) or 48 <= b <= 57 or b in b" \t\n\v\f\r" or b in stops)
    n, m, k = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    letters = sum(map(is_letter, data))
    size = [len(w) for w in words] or [0]
    mean = sum(size) / len(size)
    return [math.log1p(len(words)), letters / n, sum(65 <= b <= 90 for b in data) / max(1, letters), sum(48 <= b <= 57 for b in data) / n,
            sum(b in b" \t\n\v\f\r" for b in data) / n, sum(b in stops for b in data) / n, data.count(b"|") / m, data.count(b"!") / m,
            sum(map(is_mark, data)) / n, sum(is_mark(w[-1]) for w in words) / m, mean,
            math.sqrt(sum((s - mean) ** 2 for s in size) / len(size)), sum(s <= 3 for s in size) / len(size), len(set(words)) / m,
            max((words.count(w) for w in set(words)), default=0) / m, sum(a == b for a, b in zip(words, words[1:])) / m,
            len(set(zip(words, words[1:]))) / m, math.log1p(len(lines)), len(set(lines)) / k, m / k,
            sum(65 <= w[0] <= 90 for w in words) / m, sum(is_letter(w[-1]) for w in words) / m]


def test_scores_match_plain_lookups(spark, small_docs):
    from bisect import bisect_right
    model = op.fit(small_docs, table(spark, "/root/testdata/sf0.001", "labels"))
    assert model.tables and model.pairs
    for r in op.scored(small_docs.select("text"), model).collect():
        x = plain_features(r.text)
        assert op.features(r.text) == pytest.approx(x, rel=1e-12, abs=1e-12)
        z = model.base + sum(t[bisect_right(list(e), v)] for t, e, v in zip(model.tables, model.edges, op.features(r.text)))
        at = [bisect_right(list(e), v) for e, v in zip(model.coarse, op.features(r.text))]
        z += sum(t[at[a], at[b]] for a, b, t in model.pairs)
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9) and r.predicted == (r.score >= 0.3)
