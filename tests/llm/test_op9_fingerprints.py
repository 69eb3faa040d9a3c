import random

import xxhash
from helpers import jaccard, sha, shingle_set

from tabsmith.llm import op9_fingerprints as op


def sketch(text):
    found = sorted({xxhash.xxh64_intdigest(s, 42) >> 32 for s in shingle_set(text)})
    below = [h for h in found if h < op.BELOW]
    return below if len(below) >= op.LEAST else found[:op.LEAST]


def likeness(a, b):
    bound = min(op.SPACE if len(s) < op.LEAST else max(op.BELOW - 1, s[-1]) for s in (a, b))
    a, b = ({h for h in s if h <= bound} for s in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    out = []
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = map(sketch, (text, edited, after))
        out.append((key, len(text), sha(edited), "".join(f"{h:08x}" for h in a), "".join(f"{h:08x}" for h in b),
                    likeness(a, b), likeness(a, c)))
    return out


def check(docs, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, str(r))
    assert sorted((tuple(r) for r in op.fingerprints(docs).collect()), key=key) == sorted(brute(rows), key=key)


def test_small_table_in_many_buckets(spark, small_docs, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 7)
    check(small_docs, [(r.doc_id, r.text) for r in small_docs.collect()])


def test_odd_rows(spark, docs_of, monkeypatch):
    rows = [(5, None), (1, ""), (1, "a b c"), (1, "a b c"), (9, "é🙂 ü" * 50), (7, "x " * 3000), (None, "no id"), (-4, "a b c d e f"),
            (2 ** 62, "far away"), (12, " ".join(map(str, range(9000))))]
    check(docs_of(rows), rows)
    monkeypatch.setattr(op, "BUCKET_ROWS", 2)
    check(docs_of(rows).withColumnRenamed("lang", "sketch"), rows)
    check(docs_of(rows[:1]), rows[:1])
    assert op.fingerprints(docs_of([])).collect() == []


def test_estimates_are_close(spark, docs_of):
    from pyspark.sql import functions as F
    rng = random.Random(1)
    rows = []
    for i in range(30):
        w = [f"w{rng.randrange(10 ** 6)}" for _ in range(2000)]
        rows.append((i, " ".join(w), " ".join(w[:rng.randrange(200, 2000)])))
    df = op.with_sketch(op.with_sketch(spark.createDataFrame(rows, "i int, a string, b string"), "a", "sa"), "b", "sb")
    df = op.likeness(op.likeness(df, "sb", "sa", "inside", containment=True), "sa", "sb", "alike")
    for r in df.select("i", "inside", "alike").collect():
        true = jaccard(shingle_set(rows[r.i][1]), shingle_set(rows[r.i][2]))
        assert r.inside == 1 and abs(r.alike - true) < 0.12
    both = df.select(op.merged(F.col("sa"), F.col("sb")).alias("m"), "sa").first()
    assert set(both.m) >= set(both.sa)
