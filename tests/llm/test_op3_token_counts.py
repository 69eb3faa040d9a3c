import random

import public_tokenizers
import pytest

from tabsmith.llm import op3_token_counts as op

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "   a", "a   b ", " \n x", "▁x y", "a▁▁b", "日本語 テスト", "aaaa aaaaaaa", "<s>  </s> <unk> <0x41>", "🙂🙂 x🙂y",
       "\n\n\n", "tab\tand\r\nline", "ﬁ ² é"]


@pytest.fixture(scope="module")
def counter():
    return op.counter(PATH)


def test_every_prefix_is_exact(counter):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab ▁\nté0日theingon") for _ in range(30)) for _ in range(150)]
    for t in texts:
        assert list(counter.prefix_counts(t)) == [len(counter.library.encode(t[:i])) for i in range(len(t) + 1)], t


def test_whole_texts_match_the_library(spark, small_docs, counter):
    got = {r.doc_id: r for r in op.token_counts(small_docs, PATH).collect()}
    for r in small_docs.collect():
        n = len(counter.library.encode(r.text))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (n, len(r.text.encode()), n > 4096)


def test_bounded_memory_gives_the_same(counter):
    small = op.PrefixCounter(PATH, remember=3)
    assert [small.count(t) for t in ODD] == [counter.count(t) for t in ODD]


def test_odd_rows(spark, docs_of):
    df = docs_of([(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b")]).withColumnRenamed("lang", "n_tokens")
    rows = sorted(op.token_counts(df, PATH).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_bytes))
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in rows] == [(1, 0, 0), (1, 0, 0), (2, 3, 2), (2, 3, 2), (None, 3, 2)]
    assert op.token_counts(docs_of([]), PATH).collect() == []


def test_truncation(spark, docs_of, counter):
    text = "one two threeeee four " * 30
    r = op.truncated(docs_of([(1, text)]), PATH, 17).first()
    assert text.startswith(r.text) and r.n_tokens <= 17 and len(counter.library.encode(text[:len(r.text) + 1])) > 17
