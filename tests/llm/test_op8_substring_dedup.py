import random

import pytest
from helpers import removed_by_windows

from tabsmith.llm import op8_substring_dedup as op


def result(docs, **kw):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in op.deduplicated(docs, **kw).collect())


def want(rows, window=50):
    return sorted((k, n, n - len(kept), b" ".join(kept).decode()) for k, kept, n in removed_by_windows(rows, window))


@pytest.mark.parametrize("window", [50, 20, 7])
def test_matches_the_definition(spark, docs_of, window):
    rng = random.Random(window)
    shared = [[f"s{k}_{i}" for i in range(rng.choice([window - 1, window, window + 1, 3 * window]))] for k in range(5)]
    rows = []
    for i in range(50):
        w = [f"u{rng.randrange(300)}" for _ in range(rng.choice([0, 3, window, 4 * window]))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(shared)
        rows.append((i * 3, rng.choice([" ", "  ", "\n"]).join(w)))
    rows += [(1000, rows[10][1]), (1001, rows[10][1]), (1002, "same " * 400), (1003, "same " * 200)]
    assert result(docs_of(rows), window=window) == want(rows, window)


def test_small_table(spark, small_docs):
    assert result(small_docs) == want([(r.doc_id, r.text) for r in small_docs.collect()])


def test_odd_rows(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(5000))
    rows = [(1, None), (2, ""), (3, "a b\x1fc"), (4, long), (5, "x " + long), (6, long), (6, long)]
    docs = docs_of([*rows, (None, long)]).withColumnRenamed("lang", "kept")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in op.deduplicated(docs, keep=["source"]).collect())
    assert got == [(0, 5000, 0), (1, 0, 0), (2, 0, 0), (3, 1, 0), (4, 5000, 0), (5, 5001, 5000), (6, 5000, 5000), (6, 5000, 5000)]
    assert op.deduplicated(docs_of([])).collect() == []


def test_texts_that_share_an_id(spark, docs_of):
    x = [f"x{i}" for i in range(100)]
    passage, other = " ".join(f"p{i}" for i in range(60)), " ".join(f"q{i}" for i in range(60))
    rows = [(1, "a " + passage), (2, "b " + other + " c"),
            # one text of id 5 copies document 1, the other repeats document 2 and is repeated by 7
            (5, "a " + passage), (5, "d " + other + " " + " ".join(x[:55])), (7, "e " + " ".join(x[:55]) + " f"),
            # runs of one document whose sources, or whose positions, continue in another text of the same id
            (20, " ".join(f"y{i}" for i in range(60))), (20, " ".join([f"z{i}" for i in range(11)] + [f"y{i}" for i in range(11, 100)])),
            (21, " ".join(f"y{i}" for i in range(100))),
            (30, " ".join(f"v{i}" for i in range(100))), (31, " ".join(f"v{i}" for i in range(60))),
            (31, " ".join([f"u{i}" for i in range(11)] + [f"v{i}" for i in range(11, 100)])),
            (40, "one  " + passage), (40, "one " + passage)]
    assert result(docs_of(rows)) == want(rows)
