import random

import pytest
from helpers import groups, jaccard, shingle_set

from tabsmith.llm import op5_jaccard_join as op


def near_copies(rng, n=60):
    base = [[f"w{rng.randrange(4000)}" for _ in range(rng.choice([7, 40, 150]))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
        rows.append((i, rng.choice([" ", "\n"]).join(w)))
    return rows


def result(docs):
    return {r.doc_id: (r.class_id, r.n_links) for r in op.jaccard_groups(docs).collect()}


@pytest.mark.parametrize("block", [256, 4])
def test_matches_all_pairs(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)     # 4: components of many blocks
    rows = near_copies(random.Random(block))
    assert result(docs_of(rows)) == groups(rows)


def test_small_table(spark, small_docs):
    assert result(small_docs) == groups([(r.doc_id, r.text) for r in small_docs.collect()])


def test_odd_rows(spark, docs_of):
    long = " ".join(f"a{i}" for i in range(3000))
    rows = [(5, None), (6, ""), (7, " \n "), (1, "a b"), (2, "a  b"), (3, "a b c"), (4, long), (8, long + " end"), (None, "a b"),
            (2, "a  b")]
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in op.jaccard_groups(docs_of(rows).withColumnRenamed("lang", "rep")).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0))
    assert got == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 1), (5, 5, 0), (6, 6, 0), (7, 7, 0), (8, 4, 1), (None, None, 0)]
    assert op.jaccard_groups(docs_of([])).collect() == []


def test_texts_that_share_an_id(spark, docs_of):
    import corpus_pipeline as pipe
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    a, b, c, d = texts
    # id 1 stands on two classes with links of their own, id 5 on a near copy and a clean text
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, c), (5, c + " end"), (5, d), (5, d), (7, None), (7, "x")]
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.n_words) for r in op.jaccard_groups(docs_of(rows)).collect()))
    assert got == sorted([(1, 1, 1, 60), (1, 1, 1, 60), (2, 1, 1, 61), (3, 1, 1, 61), (4, 4, 1, 60), (5, 4, 1, 61),
                          (5, 5, 0, 60), (7, 7, 0, 0), (7, 7, 0, 1)])
    kept = pipe.near_duplicates(spark, docs_of(rows), None).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted([(1, a), (1, b), (4, c), (5, d), (7, ""), (7, "x")])
    # near copies under one id: one stays
    assert len(pipe.near_duplicates(spark, docs_of([(1, a), (1, a + " end"), (2, a)]), None).collect()) == 1


def test_components_on_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.comp for r in op.components(edges, "test").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("most", [100_000, 20])
def test_components_of_few_edges_are_kept_in_few_files(spark, monkeypatch, most):
    """Each file written to a local disk starts processes beside the executor."""
    files, written = [], op.written

    def counted(df, name):
        out = written(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(op, "written", counted)
    monkeypatch.setattr(op, "FILE_EDGES", most)
    coalesced = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesced)
    spark.conf.set(coalesced, "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(80)], "a long, b long")
        got = {r.node: r.comp for r in op.components(edges, "test").collect()}
    finally:
        spark.conf.set(coalesced, before)
    assert got == dict.fromkeys(range(81), 0)
    assert len(files) > 2 and max(files[1:]) <= 80 // most + 1


def test_pruning_keeps_every_true_link():
    import numpy as np
    rng = random.Random(2)
    limits, factors = op.prune_limits(), op._multipliers()
    for _ in range(40):
        w = [f"w{rng.randrange(9999)}" for _ in range(120)]
        v = list(w)
        for _ in range(rng.randrange(4)):
            v[rng.randrange(len(v))] = "changed"
        a, b = " ".join(w), " ".join(v)
        sig = [(op.minhash(op.shingles(t.encode().split()), factors) >> np.uint64(48)).astype(np.uint16)[None] for t in (a, b)]
        if jaccard(shingle_set(a), shingle_set(b)) >= 0.8:
            assert len(op.candidates(*sig, False, limits)[0]) == 1
