import math
import re
from collections import Counter

import numpy as np
import pytest

from tabsmith.llm import op11_ranked_search as op

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def by_definition(docs, items, k=10):
    held = [(key, terms(t)) for key, t in docs]
    held = [(key, Counter(t), len(t)) for key, t in held if t]
    total, length = len(held), sum(h[2] for h in held)
    out = set()
    for item, text in {i for i in items if i[1] is not None}:
        scored = []
        for key, tf, n in held:
            score = 0
            for t in set(terms(text)):
                if tf[t]:
                    df = sum(1 for h in held if h[1][t])
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
                    m = 100 - 90 + (90 * n * total) // length
                    score += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out |= {(item, i, s[3], -s[0], text) for i, s in enumerate(sorted(scored)[:k], 1)}
    return sorted((x[:4] for x in out), key=repr)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "doc_id long, text string, score int, rank int")
    i = spark.createDataFrame([(a, b, 3) for a, b in items], "item_id long, text string, doc int")
    return sorted((tuple(r) for r in op.ranked(d, i, **kw).collect()), key=repr)


ODD = [(1, None), (2, ""), (3, "...  !"), (4, "The cat"), (4, "The cat"), (4, "cat cat dog"), (None, "the cat"), (None, None),
       (5, "ÜBER über Über"), (6, "a1b2-c3_d4"), (7, "the " * 3000 + "cat"), (8, "\x00nul\x00 dog"), (9, "x" * 50_000), (-3, "dog THE"),
       (10, "the cat"), (11, "the cat")]
ASKED = [(1, "The CAT!"), (1, "The CAT!"), (1, "dog"), (2, None), (3, ""), (4, "nowhere"), (None, "über"), (5, "d4 c3_a1b2"),
         (6, "nul dog the cat Über"), (7, "x" * 50_000)]


@pytest.mark.parametrize("k", [1, 3, 10])
def test_odd_rows(spark, k):
    assert got(spark, ODD, ASKED, k=k) == by_definition(ODD, ASKED, k)


def test_blocks_and_shards_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_CHARS", 20)
    some = [x for x in ASKED if len(x[1] or "") < 100]
    assert got(spark, ODD, some, k=3) == by_definition(ODD, some, 3)


def test_empty_tables(spark):
    assert got(spark, [], ASKED) == [] and got(spark, ODD, []) == [] and got(spark, [(1, None)], ASKED) == []
    assert got(spark, ODD, [(1, None), (2, "...")]) == []


def test_terms_are_the_contracts():
    text = "".join(map(chr, range(0, 0x250))) + "漢字ABC🙂Z"
    assert [t.decode() for t in op.terms_of(text)] == terms(text)


@pytest.mark.parametrize("seed", range(30))
def test_stopping_early_loses_nothing(seed):
    """Shards one after another against scores of all documents; reads fewer positions than the lists hold."""
    rng = np.random.default_rng(seed)
    width, k = 30, int(rng.integers(1, 8))
    weights = np.sort(rng.integers(0, 9000, width))[::-1].copy()
    docs = []
    for key in rng.permutation(600):
        t = np.flatnonzero(rng.random(width) < 0.5 / np.arange(1, width + 1) ** 0.5)
        docs.append((int(key) // 2 if seed % 2 else int(key), int(rng.integers(1, 400)), t, rng.integers(1, 6, len(t))))
    length = sum(d[1] for d in docs)
    items = [np.sort(rng.choice(width, int(rng.integers(1, 9)), replace=False)) for _ in range(10)]
    best, read, held = [[] for _ in items], 0, 0
    for lo in range(0, len(docs), 250):
        part = docs[lo:lo + 250]
        shard = op.Shard([d[0] for d in part], np.array([d[1] for d in part]), [d[2] for d in part], [d[3] for d in part],
                         weights, len(docs), length)
        for i, t in enumerate(items):
            best[i], n = shard.search(t, best[i], k)
            read += n
            held += int((shard.bounds[t + 1] - shard.bounds[t]).sum())
    for t, own in zip(items, best):
        want = []
        for key, n, dt, tf in docs:
            m = 10 + (90 * n * len(docs)) // length
            s = sum(int(weights[x]) * ((10 ** 9 * int(c)) // (1000 * int(c) + 8 * m)) for x, c in zip(dt, tf) if x in t)
            if s > 0:
                want.append((-s, key))
        assert sorted((-s, key) for s, _, _, key in own) == sorted(want)[:k]
    assert read <= held
