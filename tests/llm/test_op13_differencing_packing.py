import zlib

import numpy as np
import public_tokenizers
import pytest

from tabsmith.llm import op13_differencing_packing as op

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, docs, max_len):
    """Each id lies in one piece, sequences are gapless and within the limit; returns
    (sequences, ids, padding, documents cut though they fit)."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    want = sorted((repr(k), tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])) for k, t in docs)
    pieces = {}
    for r in rows:
        pieces.setdefault(repr(r.doc_id), []).append(r)
    for key in {k for k, _ in want}:
        mine, all_ids = pieces.pop(key), [ids for k, ids in want if k == key]
        if len(all_ids) == 1:
            assert sum(r.length for r in mine) == len(all_ids[0])
        for r in mine:
            assert any(r.doc_tokens == len(ids) and zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
                       == r.ids_crc32 for ids in all_ids)
        for ids in set(all_ids):
            at = [0] * len(ids)
            for r in mine:
                if r.doc_tokens == len(ids):
                    for i in range(r.start, r.start + r.length):
                        at[i] += 1
            assert set(at) == {sum(len(x) == len(ids) for x in all_ids)}
    assert not pieces
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= max_len
        padding += 0 if at & (at - 1) == 0 else max_len - at
    return len(by), sum(r.length for r in rows), padding, len({r.doc_id for r in rows if r.length < r.doc_tokens <= max_len})


def test_small_table_has_no_padding_and_few_cuts(spark, small_docs):
    docs = [(r.doc_id, r.text) for r in small_docs.collect()]
    n, ids, padding, cut = check(op.packed_documents(small_docs, PATH).collect(), docs, 2048)
    assert padding == 0 and n <= ids // 2048 + 12 * small_docs.rdd.getNumPartitions()
    assert cut < 0.5 * len(docs)


def test_small_table_without_cuts(spark, small_docs):
    docs = [(r.doc_id, r.text) for r in small_docs.collect()]
    n, ids, padding, cut = check(op.packed_documents(small_docs, PATH, cut=False).collect(), docs, 2048)
    assert cut == 0 and n <= 1.2 * ids / 2048 + 2


ODD = [(1, None), (2, ""), (3, "a b  c\n\nd"), (3, "a b  c\n\nd"), (4, "Ünïcode İstanbul 漢字 x" * 40), (None, "no id"), (None, None),
       (5, "<|endoftext|> it's 42"), (6, "same"), (7, "same"), (8, "é   \t tab"), (9, " lead"), (10, "   three"), (11, "trail "),
       (12, "trail  "), (13, "a \n b\n c\n\n d  \n"), (14, "x  <|endoftext|>  y <|ENDOFTEXT|>"), (15, "    z　 \x1c \x1f q"),
       (16, " "), (17, "  "), (18, "\n"), (19, "don't I'll 3rd a_b ... !!"), (20, "a\r\n b\t c\x0b \x0c d"), (21, "Ġ Ġx x"), (22, "Ġa b")]


@pytest.mark.parametrize("max_len", [16, 5, 1])
@pytest.mark.parametrize("cut", [True, False])
def test_odd_rows(spark, docs_of, max_len, cut):
    check(op.packed_documents(docs_of(ODD), PATH, max_len, cut=cut).collect(), ODD, max_len)


def test_word_ids_are_the_tokenizers_own():
    from tokenizers import Tokenizer
    tok, rng = Tokenizer.from_file(PATH), np.random.default_rng(1)
    alphabet = [" ", " ", "  ", "\n", "\t", "\r", "a", "bc", "don't", "É", "漢", "1", "23", ".", ",", "!?", " ", "\x1c", "<|endoftext|>", "🙂", "Ġ"]
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 14)))) for _ in range(4000)]
    texts += [f"a{chr(c)}b 1{chr(c)} {chr(c)}  {chr(c)}{chr(c)}'{chr(c)}" for c in [*range(0x3000), *range(0x3000, 0x20000, 97)]
              if not 0xD800 <= c < 0xE000]
    quick, plain = op.ByteTokens(PATH, limit=50), op.ByteTokens(PATH, limit=50)
    assert quick.quick
    plain.quick = None
    for text, ids, same in zip(texts, quick.of(texts), plain.of(texts)):
        assert ids == same
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_empty_table_and_ids(spark, docs_of):
    out = op.packed_documents(docs_of([]), PATH)
    assert out.collect() == [] and out.columns[0] == "doc_id"
    docs = docs_of([(1, "hello world")]).withColumnRenamed("lang", "sequence_id").withColumnRenamed("source", "offset")
    r = op.packed_documents(docs, PATH, with_ids=True).collect()
    assert sum(len(x.ids) for x in r) == 3 and all(zlib.crc32(np.array(x.ids, "<u4").tobytes()) == x.ids_crc32 for x in r)


@pytest.mark.parametrize("seed", range(40))
def test_windows_hold_every_id_once(seed):
    rng = np.random.default_rng(seed)
    cap = int(rng.integers(1, 300))
    sizes = rng.integers(1, int(rng.integers(1, 3 * cap)) + 1, int(rng.integers(0, 200))).tolist()
    for cut in (True, False):
        seen = [np.zeros(s, int) for s in sizes]
        windows = list(op.group_windows(sizes, cap, cut))
        for w in windows:
            assert 0 < sum(x[2] for x in w) <= cap
            for i, start, length in w:
                seen[i][start:start + length] += 1
        assert all((s == 1).all() for s in seen)
        if cut:
            short = [sum(x[2] for x in w) for w in windows if sum(x[2] for x in w) < cap]
            assert all(x & (x - 1) == 0 for x in short) and len(set(short)) == len(short)
        else:
            assert all(len([w for w in windows if any(x[0] == i for x in w)]) == 1 for i, s in enumerate(sizes) if s < cap)


@pytest.mark.parametrize("seed", range(10))
def test_differencing_is_near_equal(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 12))
    lengths = rng.integers(1, 1000, 40 * k)
    window = op.differenced(lengths, k)
    sums = np.bincount(window, lengths, k)
    assert len(window) == len(lengths) and sums.max() - sums.min() <= 30


def test_two_way_differencing_is_the_textbook_one():
    assert sorted(np.bincount(op.differenced(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]
    assert sorted(np.bincount(op.differenced(np.array([4, 5, 6, 7, 8]), 3), [4, 5, 6, 7, 8])) == [8, 11, 11]
