import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from tabsmith.llm import op1_packing as op

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, max_len):
    """Pieces cover every document once, and sequences are gapless and within the limit."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    want = []
    for key, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), max_len)):
            part = ids[at:at + max_len]
            want.append((key, k, at, len(part), zlib.crc32(part.tobytes())))
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= max_len
    return len(by), sum(w[3] for w in want)


def test_small_table_is_packed_near_the_bound(spark, small_docs):
    rows = op.packed_documents(small_docs, PATH).collect()
    n, tokens = check(rows, [(r.doc_id, r.text) for r in small_docs.collect()], 4096)
    assert n <= 1.02 * tokens / 4096 + 2


def test_odd_rows(spark, docs_of):
    data = [(1, None), (2, ""), (3, "a b  c\n\nd"), (3, "a b  c\n\nd"), (4, "Ünïcode İstanbul 漢字 x" * 40), (5, "<|endoftext|> it's 42"),
            (None, "no id"), (6, "same"), (7, "same"), (8, "é   \t tab")]
    check(op.packed_documents(docs_of(data), PATH, 16).collect(), data, 16)


def test_special_tokens_in_other_case(spark, docs_of):
    data = [(1, "A <|ENDOFTEXT|> b"), (2, "<|EndOfText|>"), (3, "The<|endoftext|>End <|EndOfText|>."), (4, "\u6f22 <|ENDOFTEXT|>"),
            (5, "<|StartOfText|>x <|startoftext|> Y"), (6, "<| ENDOFTEXT |> <|END")]
    check(op.packed_documents(docs_of(data), PATH, 16).collect(), data, 16)


def test_empty_table(spark, docs_of):
    out = op.packed_documents(docs_of([]), PATH)
    assert out.collect() == [] and "sequence_id" in out.columns


def test_ids_come_back(spark, docs_of):
    r = op.packed_documents(docs_of([(1, "hello world")]).withColumnRenamed("lang", "sequence_id"), PATH, with_ids=True).first()
    assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.ids[-1] == 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    most = int(rng.integers(1, 200))
    counts = np.zeros(most + 1, np.int64)
    np.add.at(counts, rng.integers(1, most + 1, int(rng.integers(0, 3000))), int(rng.integers(1, 40)))
    used, n = np.zeros(most + 1, np.int64), 0
    for pattern, repeats in op.plan(counts):
        assert repeats > 0 and sum(a * b for a, b in pattern) <= most
        for length, each in pattern:
            used[length] += each * repeats
        n += repeats
    assert (used == counts).all()
    assert n <= 1.25 * (counts * np.arange(most + 1)).sum() / most + 5


@pytest.mark.parametrize("shape", ["uniform", "middle", "few", "short", "hot"])
def test_never_more_sequences_than_best_fit(shape):
    rng = np.random.default_rng(7)
    lengths = {"uniform": rng.integers(1, 4097, 20_000), "middle": rng.integers(900, 2201, 20_000),
               "few": rng.choice([700, 1300, 1500, 2600], 20_000), "short": rng.integers(1, 60, 20_000),
               "hot": np.where(rng.random(20_000) < 0.4, 1366, rng.integers(1, 4097, 20_000))}[shape]
    counts = np.bincount(lengths, minlength=4097)
    total = lambda p: sum(n for _, n in p)
    assert -(-lengths.sum() // 4096) <= total(op.plan(counts)) <= total(op.best_fit(counts))


def test_words_in_use_outlast_words_that_occur_once(monkeypatch):
    tokens, learned = op.WordTokens(PATH, limit=40), []
    learn = tokens._learn
    monkeypatch.setattr(tokens, "_learn", lambda words: (learned.extend(words), learn(words)))
    texts = [" ".join(["common", *(f"w{i}x{j}" for j in range(9)), f"name{chr(97 + i % 26)}q."]) for i in range(60)]
    found = []
    for text in texts:
        found += tokens.of([text])
        assert len(tokens.known) + len(tokens.before) <= 40 + 2 * 12
    assert learned.count("common") == 1
    assert found == [tokens._ids(t) for t in texts]


def test_words_between_marks_take_the_tokenizers_ids():
    tokens = op.WordTokens(PATH)
    texts = ['"Word" (word), word; --word!!! $word$ word\'s \'word\' word.,. a_b __w__ É!? ß: <word> <|word|>',
             "(<|endoftext|>) <|EndOfText|>. <|startoftext|>word!", "x1! 1x! wo-rd! word!1 !word\u00b7 \u00b5! \u6f22! !!!"]
    assert tokens.of(texts) == [tokens._ids(t) for t in texts]
    assert {"(", "!!!", "$"} <= set(tokens.marks)       # their letters went through the merges with all others


def test_a_worker_remembers_a_bounded_number_of_words():
    tokens = op.WordTokens(PATH)
    for lo in range(0, 130_000, 5_000):
        tokens.of([" ".join(np.base_repr(i + 1_000_000, 36) for i in range(lo, lo + 5_000))])
        assert len(tokens.known) + len(tokens.before) <= 100_000 + 2 * 5_000


def learning(tokens, monkeypatch):
    """The words that go through the tokenizer from now on."""
    learned, learn = [], tokens._learn
    monkeypatch.setattr(tokens, "_learn", lambda words: (learned.extend(words), learn(words)))
    return learned


def test_a_word_goes_through_the_tokenizer_once_in_a_group(monkeypatch):
    """Many words that are not remembered come again in each batch of a task."""
    names = [a + b + c for a in ("ka", "lo", "mir", "ten") for b in "bdfgklmnprst" for c in ("an", "el", "is", "um")]
    texts = [" ".join(f"{n}{chr(97 + i % 26)}{m}" for n in names for m in ("", ".")) for i in range(26)]
    batches = [pd.DataFrame({"id": pd.array([*range(26)], "Int64"), "text": texts}) for _ in range(12)]
    tokens = op.WordTokens(PATH, limit=100)
    learned, found, ids = learning(tokens, monkeypatch), [], []
    for keys, own in op.regrouped(iter(batches)):
        ids += keys
        found += tokens.of(own)
    assert len(learned) == len(set(learned)) == len(set(" ".join(texts).split()))
    assert ids == [*range(26)] * 12 and found == [tokens._ids(t) for t in texts] * 12


def test_groups_across_batches_hold_every_row_once():
    texts = ["x" * n for n in (0, 5, 700, 30, 2000, 1, 0, 450)] + [None]
    batches = [pd.DataFrame({"id": pd.array([1, None, 3], "Int64"), "text": pd.Series(texts[i:i + 3], dtype=object)}) for i in (0, 3, 6)]
    got = list(op.regrouped(iter(batches), 1_000))
    assert [x for keys, _ in got for x in keys] == [1, None, 3] * 3
    assert [x for _, own in got for x in own] == [t or "" for t in texts]
    assert [len(own) for _, own in got] == [3, 2, 4]
    assert list(op.regrouped(iter([batches[0][:0]]))) == []


def test_of_a_large_group_the_most_frequent_words_are_remembered(monkeypatch):
    tokens = op.WordTokens(PATH, limit=40)
    often, rare = [f"often{chr(97 + i)}" for i in range(26)], [f"w{i}x" for i in range(300)]
    tokens.of([" ".join(rare + often), " ".join(often)])
    assert len(tokens.known) + len(tokens.before) <= 40
    learned = learning(tokens, monkeypatch)
    assert tokens.of([" ".join(often)]) == [tokens._ids(" ".join(often))] and not learned


def test_a_group_of_many_different_words_is_halved(monkeypatch):
    tokens, texts = op.WordTokens(PATH), [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(33)]
    monkeypatch.setattr(op, "GROUP_WORDS", 50)
    learn, most = tokens._learn, []
    monkeypatch.setattr(tokens, "_learn", lambda words: (most.append(len(words)), learn(words)))
    assert tokens.of(texts) == [tokens._ids(t) for t in texts]
    assert max(most) <= 50
