import random
import zlib

import numpy as np
import pytest

from tabsmith.llm import op6_toxicity as op
from tabsmith.llm.common import table


def all_segments(scores):
    """Maximal scoring segments by the recursive definition: the best, then both sides."""
    best, at = 0.0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > best + 1e-9:
                best, at = s, (i, j)
    if at is None:
        return []
    i, j = at
    return all_segments(scores[:i]) + [(i, j, best)] + [(a + j, b + j, s) for a, b, s in all_segments(scores[j:])]


@pytest.mark.parametrize("seed", range(30))
def test_segments_match_the_definition(seed):
    rng = random.Random(seed)
    # odd parts keep sums apart, so that the maximal segments are unique
    w = np.array([x and x + rng.random() / 7 for x in rng.choices([0, 0, 0, 1, 2, 4], k=rng.randrange(25))], float)
    got = [(a, b, round(s, 6)) for a, b, s in op.segments(w)]
    assert got == [(a, b, round(s, 6)) for a, b, s in all_segments([x - op.DRIFT for x in w])]


def test_held_out_texts_are_told_apart(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice("one two three four five six seven".split()) for _ in range(rng.randrange(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "awfulish", "awfulness", "awfuler"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(9000, None), (9001, ""), (9002, "calm words"), (9002, "calm words"), (None, "x")],
                                 "doc_id long, text string")
    out = op.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.predicted == truth[r.doc_id] for r in held) and len(held) > 200
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) for r in out)
    assert len(out) == 905 and all(r.predicted == 0 and 0 <= r.score <= 1 for r in out if r.doc_id in (None, 9000, 9001, 9002))


def test_labels_of_one_class_none_and_empty_tables(spark, docs_of):
    docs = docs_of([(1, "a"), (2, "b")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in op.toxicity(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, toxic int")
    assert {r.score for r in op.toxicity(docs, one).collect()} == {1.0}
    assert op.toxicity(docs_of([]), one).collect() == []


def test_accuracy_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    out = op.toxicity(table(spark, sf, "documents"), labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted for r in out if r.toxic]) >= 0.7
    assert np.mean([r.predicted for r in out if not r.toxic]) <= 0.02


def test_weights_and_scores_match_plain_counting(spark, docs_of):
    """Weights from counts of texts by hand, scores from the definition of segments."""
    import math
    import re
    rng = random.Random(8)
    rows, truth = [], {}
    for i in range(400):
        w = [rng.choice("One two, three four. five six".split()) for _ in range(rng.randrange(3, 20))]
        if i % 5 == 0:
            w[rng.randrange(len(w)):0] = rng.choices(["vile!", "awfulish", "Awfulness"], k=2)
        rows.append((i, " ".join(w)))
        truth[i] = int(i % 5 == 0)
    rows += [(900, None), (901, ""), (902, "vile " * 3000)]
    docs = docs_of(rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "held_out")
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    model = op.fit(docs, labels)
    sample = {t: truth[k] for k, t in rows if k in truth and zlib.crc32(str(k).encode()) % 3 != 1}
    held = {}
    for text, label in sample.items():
        keys = {k for w in re.findall(r"\w+", text.lower()) for k in [w + "$", *(w[:n] for n in (4, 5, 6) if len(w) > n)]}
        for k in keys:
            held.setdefault(k, [0, 0])[label] += 1
    toxic, clean = sum(sample.values()), len(sample) - sum(sample.values())
    want = {}
    for k, (c, t) in held.items():
        if t >= op.LEAST_TEXTS and t * clean > 2 * c * toxic:
            prior = max(1e-9, op.PRIOR * (t + c) / (toxic + clean))
            odds = math.log((t + prior) / (toxic + op.PRIOR - t - prior)) - math.log((c + prior) / (clean + op.PRIOR - c - prior))
            low = odds - op.LOWER * math.sqrt(1 / (t + prior) + 1 / (c + prior))
            if low > op.KEEP:
                want[k] = low
    assert want and model.weights == pytest.approx(want)
    law = model.law
    for r in op.toxicity(docs, labels).collect():
        tokens = (dict(rows)[r.doc_id] or "").lower().split()
        scores = [max([0.0] + [want.get(k, 0.0) for w in re.findall(r"\w+", t) for k in [w + "$", *(w[:n] for n in (4, 5, 6) if len(w) > n)]])
                  for t in tokens]
        sums = [s for _, _, s in all_segments([x - op.DRIFT for x in scores])] if len(tokens) < 100 else [sum(scores) - op.DRIFT * len(tokens)]
        chance = [math.log(law.k * max(1, len(tokens))) - law.rate * s for s in sums]
        evidence = sum(max(0.0, -e) for e in chance if e < math.log(op.SIGNIFICANT))
        assert r.score == pytest.approx(1 / (1 + math.exp(-law.slope * math.log1p(evidence) - law.shift)), rel=1e-6)
        assert r.predicted == (r.score >= 0.7)
