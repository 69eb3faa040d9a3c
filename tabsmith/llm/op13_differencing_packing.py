"""Packing by Karmarkar-Karp multiway differencing.

1. *Tokens.* Every document becomes token ids and an end id. Texts are cut at spaces
   at which the tokenizer cuts anyway, and words already met are looked up.
2. *Groups.* Documents are taken in groups of about ``WINDOWS`` windows in the order
   in which a task reads them. Groups are packed apart, so no step grows with the
   table and nothing is shuffled; a group is about 8 MB of ids.
3. *Differencing.* Of a document longer than a window whole windows are cut off;
   the rests and the shorter documents are numbers to be parted into ``k`` windows.
   Each starts as a partial partition (one window filled, the others empty). The
   two partitions of greatest imbalance (largest less smallest window) are merged
   again and again, the largest windows of the one onto the smallest of the other,
   until one partition of near-equal windows is left. ``k`` is the least count whose
   windows hold the group; it rises whenever their capacity is exceeded.
4. *Cuts.* Differencing makes windows near-equal, not equal. With ``cut`` what a
   window has beyond its capacity is cut off its longest piece and fills the room
   of others, so that all windows but one are full; the ids of that one are cut
   into lengths that are powers of two, which need no padding. Without ``cut``
   documents that fit a window stay whole, and ``k`` rises until each window fits.

Sequence ids are the task's partition number times 2^36 plus a count, so a task that
runs again after a lost executor gives the same ids to the same rows.

Cases: NULL and empty text is the end id alone; very long texts are cut into windows
one document at a time; ties of imbalance go by input order; rows that repeat an
id are packed one by one; NULL ids stay NULL; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc
from .op1_packing import groups

#: Windows of a group, about.
WINDOWS = 1024

Piece = tuple[int, int, int]   # document's place in its group, first id, ids


# Fixed value: the pattern at which byte-level vocabularies of this kind cut texts.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _ranked(path: str):
    """The file's vocabulary for ``tiktoken``, or None if its merges or its way of cutting
    texts differ from what that library does."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in pairs]
    if (spec["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True)
            or model.get("ignore_merges") or model.get("dropout") or any(a >= b for a, b in zip(ids, ids[1:]))):
        return None
    # visible bytes stand for themselves, the others for the characters from 256 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    made = {a + b for a, b in pairs} | set(byte)
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t in made}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class ByteTokens:
    """Token ids (little-endian, 4 bytes each) of whole texts under a byte-level
    vocabulary; remembers words, in bounded memory.

    The tokenizer never joins a space with what stands before it, except inside a
    longer run of white space. So texts are cut before every space; a text with a
    space between two white-space characters, or with an added token, is not cut. New
    words are tokenised many at a time: in their joined ids a word begins at each
    token that begins with the byte of a space. Where the file's merges come in the
    order of their ids, all but the texts with added tokens go through ``tiktoken``
    with the file's own vocabulary, which then merges alike; else through the tokenizer.
    """

    _inner = re.compile(r"\s (?:\s|\Z)").search
    _plain = re.compile(r"\S+").fullmatch

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.limit, self.known, self.firsts = limit, {}, {}
        self.whole = Tokenizer.from_file(path)
        self.begins = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab().items():
            self.begins[i] = token.startswith("Ġ")
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.quick = _ranked(path)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens."""
        if self.quick:
            return [np.array(self.quick.encode_ordinary(t), "<u4").tobytes() for t in texts]
        return self._by_tokenizer(texts)

    def _by_tokenizer(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        new, others = [], []
        for word in words:
            (new if self._plain(word) else others).append(word)
        for word, ids in zip(others, self._encoded([" " + w for w in others])):
            self.known[word] = ids
        for lo in range(0, len(new), 50_000):
            part = new[lo:lo + 50_000]
            joined = " " + " ".join(part)
            [data] = self._encoded([joined])
            at = np.flatnonzero(self.begins[np.frombuffer(data, "<u4")]) * 4
            for word, a, b in zip(part, at.tolist(), [*at[1:].tolist(), len(data)]):
                self.known[word] = data[a:b]

    def of(self, texts: list[str]) -> list[bytes]:
        special = [any(a in t for a in self.added) for t in texts]
        cut = [not s and not self._inner(t) for t, s in zip(texts, special)]
        split = [t.split(" ") if c else [t] for t, c in zip(texts, cut)]
        heads = [words[0] for words in split]
        if len(self.known) > self.limit:
            self.known.clear()
        if len(self.firsts) > self.limit // 8:
            self.firsts.clear()
        first = list({h for h, c in zip(heads, cut) if c and h not in self.firsts})
        self.firsts.update(zip(first, self._encoded(first)))
        whole = iter([(self._by_tokenizer if s else self._encoded)([t])[0] for t, c, s in zip(texts, cut, special) if not c])
        get = self.known.get
        found = [list(map(get, words[1:])) for words in split]
        new = {w for words, ids in zip(split, found) if None in ids for w, i in zip(words[1:], ids) if i is None}
        if new:
            self._learn(new)
            found = [list(map(get, words[1:])) if None in ids else ids for words, ids in zip(split, found)]
        return [(self.firsts[h] if c else next(whole)) + b"".join(ids) for h, c, ids in zip(heads, cut, found)]


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


def differenced(lengths: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k-1) of each length, by multiway differencing.

    A partial partition is its ``k`` sums in falling order and, for each, a node of
    the merged lengths (-1: none). Merging adds the sums of one to those of the
    other in opposite order.
    """
    n = len(lengths)
    if k < 2 or not n:
        return np.zeros(n, np.int64)
    left, right, made = np.full(n, -1, np.int64), np.full(n, -1, np.int64), 0
    order = np.argsort(-lengths, kind="stable")
    # while it has empty windows, the partition of the longest has the greatest imbalance: it takes the first k
    sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
    sums[:min(k, n)], nodes[:min(k, n)] = lengths[order[:k]], order[:k]
    heap = [(-(int(sums[0] - sums[-1])), 0, (sums, nodes))]
    heap += [(-int(lengths[i]), at, int(i)) for at, i in enumerate(order[k:], 1)]
    heapq.heapify(heap)
    ticket = n + 1

    def opened(entry):
        if isinstance(entry, tuple):
            return entry
        one, node = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        one[0], node[0] = lengths[entry], entry
        return one, node

    while len(heap) > 1:
        (s, a), (t, b) = (opened(heapq.heappop(heap)[2]) for _ in range(2))
        t, b = t[::-1], b[::-1]
        s, both = s + t, (a >= 0) & (b >= 0)
        node = np.where(a >= 0, a, b)
        m = int(both.sum())
        if m:
            left[made:made + m], right[made:made + m] = a[both], b[both]
            node[both] = np.arange(n + made, n + made + m)
            made += m
        by = np.argsort(-s, kind="stable")
        s, node = s[by], node[by]
        heapq.heappush(heap, (-int(s[0] - s[-1]), ticket, (s, node)))
        ticket += 1
    nodes = heap[0][2][1]
    window = np.full(n + made, -1, np.int64)
    window[nodes[nodes >= 0]] = np.flatnonzero(nodes >= 0)
    for i in range(made - 1, -1, -1):
        window[left[i]] = window[right[i]] = window[n + i]
    return window[:n]


def fewest(total: int, capacity: int) -> int:
    return max(1, -(-total // capacity))


def parted(lengths: np.ndarray, capacity: int) -> list[list[Piece]]:
    """Windows of whole lengths (none longer than ``capacity``): the count rises
    until differencing leaves no window above its capacity."""
    k = fewest(int(lengths.sum()), capacity)
    while True:
        window = differenced(lengths, k)
        sums = np.bincount(window, lengths, k).astype(np.int64)
        if sums.max(initial=0) <= capacity:
            return [w for w in _pieces(window, lengths, k) if w]
        k += max(1, int(np.maximum(sums - capacity, 0).sum()) // capacity)


def _pieces(window: np.ndarray, lengths: np.ndarray, k: int) -> list[list[Piece]]:
    out: list[list[Piece]] = [[] for _ in range(k)]
    for i, (w, length) in enumerate(zip(window.tolist(), lengths.tolist())):
        out[w].append((i, 0, length))
    return out


def filled(lengths: np.ndarray, capacity: int) -> list[list[Piece]]:
    """Windows that are all full, and sequences of falling powers of two for the last,
    unless it is full: differencing first, then cuts."""
    k = fewest(int(lengths.sum()), capacity)
    windows = _pieces(differenced(lengths, k), lengths, k)
    room = [capacity - sum(p[2] for p in w) for w in windows]
    rest = max(range(k), key=room.__getitem__)
    loose: list[Piece] = []
    for w in range(k):
        while room[w] < 0:
            at = max(range(len(windows[w])), key=lambda j: windows[w][j][2])
            i, start, length = windows[w][at]
            off = min(-room[w], length)
            loose.append((i, start + length - off, off))
            windows[w][at:at + 1] = [(i, start, length - off)] if off < length else []
            room[w] += off
    # smallest last: the largest loose pieces meet the largest rooms
    loose.sort(key=lambda p: p[2])
    pool = sorted(windows[rest], key=lambda p: -p[2])[::-1] + loose
    for w in sorted((w for w in range(k) if w != rest and room[w] > 0), key=lambda w: -room[w]):
        while room[w]:
            i, start, length = pool.pop()
            used = min(room[w], length)
            if used < length:
                pool.append((i, start + used, length - used))
            windows[w].append((i, start, used))
            room[w] -= used
    last, windows = sorted(pool), [x for w, x in enumerate(windows) if w != rest]
    while last:
        size = min(capacity, 1 << (sum(p[2] for p in last).bit_length() - 1))
        if sum(p[2] for p in last) >= capacity:
            size = capacity
        out = []
        while size:
            i, start, length = last.pop(0)
            used = min(size, length)
            if used < length:
                last.insert(0, (i, start + used, length - used))
            out.append((i, start, used))
            size -= used
        windows.append(out)
    return windows


def group_windows(sizes: list[int], capacity: int, cut: bool) -> Iterator[list[Piece]]:
    """The windows of one group of documents of ``sizes`` ids."""
    rests = np.array([s % capacity for s in sizes], np.int64)
    for i, s in enumerate(sizes):
        for at in range(0, s - s % capacity, capacity):
            yield [(i, at, capacity)]
    there = np.flatnonzero(rests)
    if len(there):
        for window in (filled if cut else parted)(rests[there], capacity):
            yield [(int(there[j]), sizes[there[j]] - int(rests[there[j]]) + start, length) for j, start, length in window]


def packed_documents(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1, cut: bool = True,
                     id_col: str = "doc_id", text_col: str = "text", windows: int = WINDOWS,
                     with_ids: bool = False) -> DataFrame:
    """(``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), one row a piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def packed(keys: list, ids: list[bytes], sequence: int) -> tuple[pd.DataFrame, int]:
        rows = []
        for window in group_windows([len(x) // 4 for x in ids], max_len, cut):
            offset = 0
            for i, start, length in window:
                own = ids[i][4 * start:4 * (start + length)]
                rows.append((keys[i], start, length, crc(own), len(ids[i]) // 4, sequence, offset,
                             *([np.frombuffer(own, "<u4").astype(np.int32)] if with_ids else [])))
                offset += length
            sequence += 1
        return pd.DataFrame(rows, columns=names), sequence

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, sequence = byte_tokens(tokenizer_path), TaskContext.get().partitionId() << 36
        keys, ids, size = [], [], 0
        for batch in batches:
            own = batch["key"].astype(object).where(batch["key"].notna(), None).tolist()
            texts = [t or "" for t in batch["text"]]
            for part in groups(texts):
                for key, found in zip(own[part], tokens.of(texts[part])):
                    keys.append(key)
                    ids.append(found + end)
                    size += len(ids[-1]) // 4
                    if size >= windows * max_len:
                        out, sequence = packed(keys, ids, sequence)
                        yield out
                        keys, ids, size = [], [], 0
        if keys:
            yield packed(keys, ids, sequence)[0]

    schema = ("key string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + ", ids array<int>" * with_ids)
    out = docs.select(docs[id_col].cast("string").alias("key"), docs[text_col].alias("text")).mapInPandas(run, schema)
    return out.select(F.col("key").cast(kind).alias(id_col), *names[1:])
