"""Periodic run detection: recursive frequency splitting, then a lag scan.

A run is a stretch of words of smallest period ``q`` that is at least
``max(least, repeats * q)`` words long and that no neighbour extends.

1. *Splitting.* Every word of a run stands in it at least ``repeats`` times. So a
   word that occurs fewer times within its segment joins no run there, and splits
   the segment. The counts are taken again within the parts, until none splits
   (or after ``ROUNDS`` rounds: what is left then is scanned as it is, which
   loses nothing). All segments of a group of documents are counted together.
   Nearly all prose falls apart here.
2. *Lag scan.* For lag ``q`` a surviving segment is cut at the multiples of
   ``q``. A run of period ``q`` holds ``repeats - 1`` whole blocks, and these are
   equal. Block hashes come from one table of prefix sums, so all lags together
   read about ``n log n`` of them. Equal blocks are compared word by word and
   extended by less than a block on either side, so no result rests on a hash.
3. Stretches of lag ``q`` that belong to a run of a divisor of ``q`` are left out:
   lags go upwards, and every place knows the last run that covers it. Two runs
   of different periods overlap in fewer words than both periods together, so
   looking at one place, the middle of the first three blocks, is enough.

Documents are independent: no shuffle, and a task holds one Arrow batch.

Cases: NULL and empty text have no words and no runs; very long texts are scanned
whole, in time n log n; of runs with the greatest exponent the first by start,
then period, is the longest; repeated rows each get their own row; a row with NULL
id is taken as it stands (no rewriting) and keeps its NULL id; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, mix64, powers
from .op1_packing import groups

#: Rounds of splitting; no limit on what is found.
ROUNDS = 64
#: Block hashes looked at in one step.
STEP = 1 << 20

Run = tuple[int, int, int]   # start, length, period


class _Numbers(dict):
    """word -> its number, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def segments(words: np.ndarray, sizes: np.ndarray, least: int = 6, repeats: int = 4) -> list[tuple[int, int]]:
    """[(from, to)]: what splitting leaves of the concatenated documents."""
    pos = np.flatnonzero(np.bincount(words)[words] >= repeats) if len(words) else np.empty(0, np.int64)
    seg = np.repeat(np.arange(len(sizes)), sizes)[pos]
    width = int(words.max()) + 1 if len(words) else 1
    done: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        if not len(pos):
            return sorted(done)
        # parts: neighbouring places of one former part
        new = np.empty(len(pos), bool)
        new[0] = True
        new[1:] = (np.diff(pos) != 1) | (np.diff(seg) != 0)
        part = np.cumsum(new) - 1
        long = np.bincount(part)[part] >= least
        pos, seg = pos[long], part[long]
        if not len(pos):
            return sorted(done)
        _, at, count = np.unique(seg * width + words[pos], return_inverse=True, return_counts=True)
        rare = count[at] < repeats
        if not rare.any():
            break
        hit = np.zeros(int(seg[-1]) + 1, bool)
        hit[seg[rare]] = True
        stable = ~hit[seg]
        done += _bounds(pos[stable], seg[stable])
        keep = ~rare & ~stable
        pos, seg = pos[keep], seg[keep]
    return sorted(done + _bounds(pos, seg))


def _bounds(pos: np.ndarray, seg: np.ndarray) -> list[tuple[int, int]]:
    if not len(pos):
        return []
    first = np.flatnonzero(np.r_[True, (np.diff(pos) != 1) | (np.diff(seg) != 0)])
    last = np.r_[first[1:], len(pos)] - 1
    return list(zip(pos[first].tolist(), (pos[last] + 1).tolist()))


def equal_blocks(words: np.ndarray, repeats: int) -> Iterator[tuple[int, int, int]]:
    """(lag, from, to) by lag: whole blocks, at least ``repeats - 1`` in a row, that
    look equal."""
    n, need = len(words), repeats - 2
    power = powers(BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix64(words.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * power[:n], out=sums[1:])
    lags = np.arange(1, n // repeats + 1)
    counts = n // lags
    ends = np.cumsum(counts)
    lo = 0
    while lo < len(lags):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + STEP, "right")))
        lag = np.repeat(lags[lo:hi], counts[lo:hi])
        block = np.arange(len(lag)) - np.repeat(ends[lo:hi] - counts[lo:hi] - (ends[lo] - counts[lo]), counts[lo:hi])
        at = block * lag
        own = sums[at + lag] - sums[at]
        same = np.zeros(len(lag), bool)
        same[:-1] = (own[:-1] * power[lag[:-1]] == own[1:]) & (lag[:-1] == lag[1:])
        # stretches of neighbouring equalities never cross lags: the last block of a lag is no start
        edge = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= need:
                q = int(lag[a])
                yield q, int(at[a]), int(at[a]) + (b - a + 1) * q
        lo = hi


def scan(words: np.ndarray, least: int = 6, repeats: int = 4) -> list[Run]:
    """All runs of one segment."""
    n = len(words)
    found: list[Run] = []
    owner = np.full(n, -1, np.int64)
    for q, lo, hi in equal_blocks(words, repeats):
        mine = int(owner[lo + (repeats - 1) * q // 2])
        if mine >= 0:
            start, length, period = found[mine]
            if q % period == 0 and start <= lo and start + length >= lo + (repeats - 1) * q:
                continue
        if (words[lo:hi - q] == words[lo + q:hi]).all():
            stretches = [(lo - _matching(words, lo - 1, q, -1), hi + _matching(words, hi - q, q, 1))]
        else:   # hashes agreed by chance: the words decide
            same = np.r_[False, words[:-q] == words[q:], False]
            edge = np.flatnonzero(np.diff(same.astype(np.int8)))
            stretches = [(a, b + q) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if a < hi and b + q > lo]
        for start, end in stretches:
            if end - start >= max(least, repeats * q) and not _smaller(words[start:start + q]):
                found.append((start, end - start, q))
                owner[start:end] = len(found) - 1
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def _smaller(root: np.ndarray) -> bool:
    """Whether the block is itself a whole number of equal blocks. Stretches of a
    divisor are left out by their owner; this holds for hashes that missed one."""
    q = len(root)
    rest, p = q, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            step = q // p
            if (root[step:] == root[:-step]).all():
                return True
            while rest % p == 0:
                rest //= p
        p += 1
    return False


def _matching(words: np.ndarray, at: int, q: int, way: int) -> int:
    """Places from ``at`` on, backwards or forwards, whose word stands ``q`` later too;
    at most ``q``, as a further block would have been equal."""
    if way < 0:
        lo = max(0, at + 1 - q)
        same = (words[lo:at + 1] == words[lo + q:at + 1 + q])[::-1]
    else:
        same = words[at:len(words) - q][:q] == words[at + q:][:q]
    return int(np.argmin(same)) if not same.all() else len(same)


def longest(found: list[Run]) -> Run | None:
    """The run of greatest exact length/period; ties: smallest start, then period."""
    best = None
    for r in found:   # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def looped(key: str | None, n: int) -> tuple[int, int] | None:
    """(a, p) if the words from ``a`` on are to repeat the ``p`` words from ``a``:
    for ids whose crc32 is divisible by ten."""
    h = zlib.crc32(key.encode()) if key is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def runs_of(texts: list[str | None], loops: list[tuple | Callable | None]) -> Iterator[tuple[list[bytes], list[Run]]]:
    """(words, runs) of each text, after its words have been rewritten by its loop."""
    numbers = _Numbers()
    all_words, arrays = [], []
    for text, loop in zip(texts, loops):
        words = text.encode().split() if text else []
        own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        again = loop(len(words)) if loop else None
        if again:
            a, p = again
            own[a:] = own[a + np.arange(len(own) - a) % p]
            words[a:] = (words[a:a + p] * (-(-(len(words) - a) // p)))[:len(words) - a]
        all_words.append(words)
        arrays.append(own)
    sizes = np.array([len(a) for a in arrays], np.int64)
    whole = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    starts = np.cumsum(sizes) - sizes
    found: list[list[Run]] = [[] for _ in arrays]
    for lo, hi in segments(whole, sizes):
        doc = int(np.searchsorted(starts, lo, "right")) - 1
        found[doc] += [(lo - int(starts[doc]) + s, length, q) for s, length, q in scan(whole[lo:hi])]
    for words, own in zip(all_words, found):
        yield words, sorted(own, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not found:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, q in found:
        gone[start + q:start + length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g]


def periodic_runs(docs: DataFrame, rewrite: bool = False, id_col: str = "doc_id", text_col: str = "text",
                  with_text: bool = False) -> DataFrame:
    """One row for each document: ``id_col``, runs (array of start, length, period),
    n_runs, the longest run's start, length, period and exponent_milli,
    runs_sha256, collapsed_sha256 and, if asked for, the collapsed text.

    ``rewrite`` loops the words of every tenth document first (``looped``).
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].astype(object).where(batch["key"].notna(), None).tolist()
            texts = [t or "" for t in batch["text"]]
            for part in groups(texts):
                rows = []
                loops = [(lambda n, k=k: looped(k, n)) if rewrite else None for k in keys[part]]
                for key, (words, found) in zip(keys[part], runs_of(texts[part], loops)):
                    top = longest(found)
                    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
                    kept = b" ".join(collapsed(words, found))
                    rows.append((key, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
                                 hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
                                 [{"start": s, "length": length, "period": q} for s, length, q in found],
                                 *([kept.decode()] if with_text else [])))
                out = pd.DataFrame(rows, columns=names)
                yield out.astype({c: "Int64" for c in ("start", "length", "period", "exponent_milli")})

    schema = ("key string, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>"
              + ", collapsed string" * with_text)
    names = [f.split()[0] for f in schema.split(", ") if ":" not in f or f.startswith("runs ")]
    out = docs.select(docs[id_col].cast("string").alias("key"), docs[text_col].alias("text")).mapInPandas(run, schema)
    return out.select(F.col("key").cast(kind).alias(id_col), *names[1:])
