"""Best-fit packing: length patterns fitted by non-negative least squares.

1. Every document becomes token ids and an end id; only documents longer than a
   sequence are cut. A piece is one row, without its ids unless asked for.
2. The histogram of piece lengths (at most ``max_len`` entries, whatever the
   number of rows) goes to the driver. Patterns of up to three lengths that fill
   a sequence (nearly) are enumerated, and repeat counts are fitted to the
   histogram by non-negative least squares, with long lengths weighted more.
3. The counts are rounded down and taken while their lengths last; what remains
   is packed best fit in decreasing length, whole groups of equal sequences at a
   time. The plan is a list of (pattern, repeats); where best fit alone takes no more
   sequences, its plan is taken.
4. Each piece finds its place by its length and its rank among pieces of that
   length. Ranks are counted in ``SALTS`` parts of each length and offset by the
   parts' sizes, so a length that holds a third of all rows is no single task.

Cases: NULL text is the empty text (the end id alone); very long texts are cut into
as many pieces as they need; repeated rows are packed one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc, remembers, written

SALTS = 64
#: Lengths from which the smallest length of patterns of three is taken.
GRID = 160
#: A pattern may leave this part of a sequence open.
NEARLY = 256
#: Texts are tokenised in groups of about so many characters.
GROUP_CHARS = 1_000_000
#: And in groups of about so many here, whatever the batches: a word goes through the tokenizer once in
#: a group at most, so the many that are not remembered cost less in large groups.
WORD_CHARS = 8_000_000
#: A text counts by so many characters at least, which bounds the rows of a group.
TEXT_CHARS = 200
#: A group with more different words is halved: they are held one by one while its texts are looked up.
GROUP_WORDS = 400_000
#: Runs of marks that a worker remembers.
MARKS = 10_000


class WordTokens:
    """Token ids (little-endian, 4 bytes each) of words split at spaces and line
    breaks, at which the tokenizer splits anyway; bounded memory.

    Most new words are Latin letters, perhaps between ASCII marks other than apostrophes: their
    letters go through the merges many at a time, in lower case and without the
    tokenizer's patterns, and the marks of word ends tell them apart again. All
    other words go through the whole tokenizer.

    Words are remembered in two halves: a full one becomes ``before``, from which words
    in use come back, so words in use outlast the many that occur once. Of a group
    with more than ``limit`` words its most frequent ones are remembered.
    """

    _letters = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
    _edged = re.compile("([!-&(-/:-@\\[-`{-~]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch
    _beyond = re.compile("[^\x00-\xff]").search

    def __init__(self, path: str, limit: int = 100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.limit, self.known, self.before = limit, {}, {}
        self.whole, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.marks = {m: self._ids(m) for m in ("", ".", ",")}
        #: Added tokens are matched in the raw text, so case counts in a text that may hold one.
        self.added = [t.content.lower() for t in self.whole.get_added_tokens_decoder().values()]

    def _ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        known, before, marked, cores, others = self.known, self.before, [], set(), []
        for word in words:
            head, core, tail = "", word, ""
            if word[-1:] in ".,":
                core, tail = word[:-1], word[-1:]
            if not (core.isalpha() and (core.isascii() or self._letters(core))):
                parts = self._edged(word)
                if not parts or self._special(word):
                    others.append(word)
                    continue
                head, core, tail = parts.groups()
            core = core.lower()
            if core not in known:
                if core in before:
                    known[core] = before[core]
                else:
                    cores.add(core)
            if core != word:
                marked.append((word, head, core, tail))
        for word, found in zip(others, self.whole.encode_batch_fast(others, add_special_tokens=False)):
            known[word] = np.array(found.ids, "<u4").tobytes()
        new = list(cores)
        for lo in range(0, len(new), 20_000):
            part = new[lo:lo + 20_000]
            [found] = self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            data, at = ids.tobytes(), 0
            for core, end in zip(part, ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()):
                known[core], at = data[at:end], end
        for word, head, core, tail in marked:
            ids = known[core]
            if head:
                ids = self._mark(head) + ids
            known[word] = ids + self._mark(tail) if tail else ids

    def _mark(self, marks: str) -> bytes:
        """The ids of a run of marks: the tokenizer parts it from letters beside it."""
        if marks not in self.marks:
            if len(self.marks) > MARKS:
                self.marks = {"": b""}
            self.marks[marks] = self._ids(marks)
        return self.marks[marks]

    def _special(self, text: str) -> bool:
        low = text.lower()
        return any(t in low for t in self.added)

    def _lower(self, text: str) -> str:
        """In lower case where that changes nothing for the tokenizer, which does the same by itself."""
        if not text.isascii() and self._beyond(text):
            return text
        low = text.lower()
        return text if any(t in low for t in self.added) else low

    def _found(self, words: pa.DictionaryArray) -> list[bytes]:
        """The ids of each different word."""
        own = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known, before = self.known, self.before
        new = []
        for word in own:
            if word not in known:
                if word in before:
                    known[word] = before[word]
                else:
                    new.append(word)
        if new:
            self._learn(new)
        out = [known[word] for word in own]
        if len(known) > self.limit:
            often = np.bincount(words.indices, minlength=len(own))
            self.known = {own[i]: out[i] for i in np.argsort(-often, kind="stable")[:self.limit].tolist()}
        if len(known) > self.limit // 2:
            self.known, self.before = {}, self.known
        return out

    def of(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array([self._lower(t).replace("\n", " ") for t in texts], pa.large_string()), " ")
        words, ends = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        del split
        if len(words.dictionary) > GROUP_WORDS and len(texts) > 1:
            half = len(texts) // 2
            return self.of(texts[:half]) + self.of(texts[half:])
        ids = pa.array(self._found(words), pa.large_binary()).take(words.indices)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[ends].tolist()
        data = memoryview(data or b"")
        return [bytes(data[lo:hi]) for lo, hi in zip(at, at[1:])]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _forget() -> None:
    word_tokens.cache_clear()


def groups(texts: list[str], most: int = GROUP_CHARS) -> Iterator[slice]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def regrouped(batches: Iterator[pd.DataFrame], most: int = WORD_CHARS) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts in groups of about ``most`` characters, across batches."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch["id"].astype(object).where(batch["id"].notna(), None), batch["text"]):
            keys.append(key)
            texts.append("" if text is None else text)
            size += max(len(texts[-1]), TEXT_CHARS)
            if size >= most:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = 4096, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(``id_col``, piece, start, length, ids_crc32[, ids]) of every document."""
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembers("op1", _forget)
        tokens = word_tokens(tokenizer_path)
        for keys, texts in regrouped(batches):
            rows = []
            for key, ids in zip(keys, tokens.of(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * max_len)):
                    own = ids[at:at + 4 * max_len]
                    rows.append((key, k, at // 4, len(own) // 4, crc(own),
                                 *([np.frombuffer(own, "<u4").astype(np.int32)] if with_ids else [])))
            out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
            yield out.astype({"id": "Int64"}) if id_type in ("bigint", "int") else out

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInPandas(
        run, schema).withColumnRenamed("id", id_col)


def patterns(counts: np.ndarray) -> np.ndarray:
    """Patterns of up to three lengths that fill a sequence but for at most 1 / ``NEARLY``
    of it, as rows of three lengths padded by 0. ``counts[l]``: pieces of length
    ``l``. The smallest length of a triple is one of the ``GRID`` most frequent lengths."""
    most = len(counts) - 1
    there = np.flatnonzero(counts[1:]) + 1
    if not len(there):
        return np.empty((0, 3), np.int64)
    # the longest present length of at most l
    below = np.maximum.accumulate(np.where(np.r_[False, counts[1:] > 0], np.arange(most + 1), 0))
    spare = most // NEARLY
    other = below[most - there]
    good = (other >= there) & (most - there - other <= spare)
    pairs = np.stack([there[good], other[good], 0 * there[good]], 1)
    grid = there[np.argsort(-counts[there], kind="stable")[:GRID]]
    a, b = np.meshgrid(grid, there, indexing="ij")
    c = below[np.maximum(most - a - b, 0)]
    ok = (a <= b) & (b <= c) & (a + b + c <= most) & (most - a - b - c <= spare)
    triples = np.stack([a[ok], b[ok], c[ok]], 1)
    single = [(x, 0, 0) for x in there[there >= most - spare]]
    return np.concatenate([np.array(single, np.int64).reshape(-1, 3), pairs, triples])


def fitted(rows: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative repeats ``x`` with least ``sum(weight * (A x - counts)^2)``, by
    accelerated projected gradients; ``A`` has one column for each pattern."""
    most = len(counts) - 1
    weight = np.arange(most + 1) / most
    weight[0] = 0
    flat = rows.ravel()

    def gradient(x: np.ndarray, target: np.ndarray) -> np.ndarray:
        rest = np.bincount(flat, np.repeat(x, rows.shape[1]), most + 1) - target
        return (rest * weight)[rows].sum(1)

    v = np.ones(len(rows))
    for _ in range(20):
        v = gradient(v, np.zeros(most + 1))
        size = np.linalg.norm(v)
        v /= size or 1
    step = 1 / max(size * 1.1, 1e-9)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * gradient(y, counts.astype(float)))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """[(pattern, repeats)]: a pattern is [(length, how often)], and the plan uses
    every piece of the histogram exactly once. Fitted patterns with best fit for the
    rest, or best fit for all where that takes no more sequences."""
    left, most, out = counts.astype(np.int64).copy(), len(counts) - 1, []
    left[0] = 0
    plain = best_fit(left)
    rows = patterns(left)
    if len(rows):
        x = np.floor(fitted(rows, left) + 1e-6).astype(np.int64)
        for i in np.argsort(-x, kind="stable"):
            if x[i] <= 0:
                break
            lengths, often = np.unique(rows[i][rows[i] > 0], return_counts=True)
            n = int(min(x[i], (left[lengths] // often).min()))
            if n > 0:
                left[lengths] -= n * often
                out.append(([(int(a), int(b)) for a, b in zip(lengths, often)], n))
    out += best_fit(left)
    return min(out, plain, key=lambda p: sum(n for _, n in p))


def best_fit(counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit in decreasing length, over groups of equal sequences."""
    left, most = counts.copy(), len(counts) - 1
    open_: dict[int, list] = {}      # room -> [(pattern, repeats)]
    rooms = np.zeros(most + 1, bool)
    for length in range(most, 0, -1):
        c = int(left[length])
        while c:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = int(fits[0]) + length
                pattern, n = open_[room].pop()
                rooms[room] = bool(open_[room])
                each = min(room // length, max(1, c // n))
                used = min(n, c // each)
                if used < n:
                    open_[room].append((pattern, n - used))
                    rooms[room] = True
            else:
                each = min(most // length, c)
                used, pattern, room = c // each, [], most
            c -= used * each
            rest = room - each * length
            open_.setdefault(rest, []).append((pattern + [(length, each)], used))
            rooms[rest] = rest > 0
    return [x for groups_ in open_.values() for x in groups_]


def places(found: list[tuple[list[tuple[int, int]], int]], most: int) -> dict[str, np.ndarray]:
    """The plan as runs of ranks, sorted by length and first rank: pieces of
    ``length`` from rank ``first`` on fill ``each`` places from ``offset`` on in
    sequences from ``sequence`` on."""
    runs, ranks, sequence = [], np.zeros(most + 1, np.int64), 0
    for pattern, n in found:
        offset = 0
        for length, each in pattern:
            runs.append((length, ranks[length], sequence, each, offset))
            ranks[length] += n * each
            offset += length * each
        sequence += n
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "each", "offset"), table.T))


def packed(found: DataFrame, max_len: int = 4096, length_col: str = "length") -> DataFrame:
    """``found`` (any columns, lengths from 1 to ``max_len``) with sequence_id and
    offset. ``found`` is read twice and must give the same rows each time."""
    keep = [c for c in found.columns if c not in ("sequence_id", "offset")]
    salted = found.select(*keep).withColumn("_salt", F.pmod(F.xxhash64(*keep), F.lit(SALTS)).cast("int"))
    sizes = salted.groupBy(F.col(length_col).alias("l"), "_salt").count().collect()   # max_len * SALTS rows at most
    parts = np.zeros((max_len + 1, SALTS), np.int64)
    for r in sizes:
        parts[r["l"], r["_salt"]] = r["count"]
    before = np.cumsum(parts, 1) - parts
    at = places(plan(parts.sum(1)), max_len)
    # runs of one length are neighbours: one sorted key answers both searches
    width = int(parts.sum()) + 1
    key = at["length"] * width + at["first"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length = batch[length_col].to_numpy(np.int64)
            rank = before[length, batch["_salt"].to_numpy()] + batch["_rank"].to_numpy(np.int64) - 1
            i = np.searchsorted(key, length * width + rank, "right") - 1
            step = rank - at["first"][i]
            out = batch[keep].copy()
            out["sequence_id"] = at["sequence"][i] + step // at["each"][i]
            out["offset"] = at["offset"][i] + step % at["each"][i] * length
            yield out

    order = Window.partitionBy(length_col, "_salt").orderBy(*[c for c in keep if c != "ids"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.select(*keep).schema)
    return salted.withColumn("_rank", F.row_number().over(order)).mapInPandas(
        run, f"{fields}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer_path: str, max_len: int = 4096, end_id: int = 1,
                     with_ids: bool = False) -> DataFrame:
    """Documents -> pieces -> places. The pieces are written once to the shared
    folder, so tokens are computed once and a lost executor re-reads them."""
    return packed(written(pieces(docs, tokenizer_path, max_len, end_id, with_ids=with_ids), "op1-pieces"), max_len)
