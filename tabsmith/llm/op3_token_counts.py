"""Token counts: prefix dynamic programming over a piece vocabulary.

The tokenizer merges inside chunks only: a chunk is a run of word marks (a
space, or the mark itself) and the characters up to the next run, and no piece
holds a mark after another character. Within a chunk a segmentation is what
the merges give exactly if every pair of neighbouring pieces is what the merges
give for the two alone. So for every prefix one table entry is enough: its last
piece and its number of tokens. ``count[i] = count[i - len(p)] + cost(p)``,
where ``p`` is the piece that ends at ``i`` and agrees with the last piece of the
shorter prefix. The table answers the token count of every prefix: truncation
to a budget and budget questions need no second encoding.

Cases: NULL counts as the empty text (0 tokens); repeated rows give one row
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

MARK = "▁"
NEVER = float("inf")
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PrefixCounter:
    """Exact token counts of every prefix of a text.

    ``remember`` bounds each of the two memories (chunk tables, neighbour
    checks); forgotten entries are computed again.
    """

    def __init__(self, model_path: str, remember: int = 1_000_000):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        lib = self.library
        self.rank = {lib.id_to_piece(i): -lib.get_score(i) for i in range(lib.get_piece_size())
                     if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))}
        self.remember = remember
        self.made_of: dict[str, tuple[str, str] | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        # every beginning of a piece -> whether the merges make it out of its characters
        self.begins: dict[str, bool] = {p[:i]: False for p in self.rank for i in range(1, len(p))}
        self.begins.update({p: len(p) == 1 or self.parts(p) is not None for p in self.rank})
        self.words: dict[str, int] = {}
        # a line break has no piece: it stands apart, so what follows it is
        # encoded as if it began the text, without the mark put before a text
        self.lead = len(lib.encode("\n"))

    def parts(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge is the last that makes ``piece``; None for one
        that no merge makes (a single character, or a piece out of the merges' reach)."""
        if piece in self.made_of:
            return self.made_of[piece]
        symbols, ranks, last = list(piece), self.rank, None
        while len(symbols) > 1:
            best, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if best == NEVER:
                break
            last = (symbols[at], symbols[at + 1])
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        found = self.made_of[piece] = last if len(symbols) == 1 else None
        return found

    def agree(self, left: str, right: str) -> bool:
        """Whether the merges leave ``left`` and ``right`` as they are side by side.

        Their last merges are undone from the later one down. The border is crossed
        if at some moment the two pieces that touch it would merge before the merge
        that was undone last; at equal rank the one further left goes first.
        """
        rank, a, b = self.rank, left, right
        before = (NEVER, 0)
        while True:
            joint = rank.get(a + b)
            if joint is not None and (joint, 1) < before:
                return False
            undo_a, undo_b = self.parts(a), self.parts(b)
            if undo_a is None and undo_b is None:
                return True
            if undo_b is None or (undo_a is not None and rank[a] > rank[b]):
                before, a = (rank[a], 0), undo_a[1]
            else:
                before, b = (rank[b], 2), undo_b[0]

    def chunk_table(self, chunk: str) -> list[int]:
        """Tokens of every prefix of one chunk, from 0 characters to all."""
        if chunk.startswith(MARK * 2):
            # runs of marks share one merge rank, so neighbour checks do not
            # settle them: the chunk's prefixes are asked of the library
            return [self._direct(chunk[:i]) for i in range(len(chunk) + 1)]
        begins, fits, n = self.begins, self.fits, len(chunk)
        counts: list[int] = [0] * (n + 1)
        last: list[str | None] = [None] * (n + 1)
        for start in range(n):
            before = last[start]
            if start and before is None:
                # a character without a piece: its bytes, and nothing merges across it
                counts[start] = counts[start - 1] + len(chunk[start - 1].encode())
            for end in range(start + 1, n + 1):
                piece = chunk[start:end]
                usable = begins.get(piece)
                if usable is None:
                    break
                if usable and last[end] is None:
                    if before is not None:
                        usable = fits.get((before, piece))
                        if usable is None:
                            if len(fits) >= self.remember:
                                fits.clear()
                            usable = fits[before, piece] = self.agree(before, piece)
                    if usable:
                        counts[end] = counts[start] + 1
                        last[end] = piece
        if n and last[n] is None:
            counts[n] = counts[n - 1] + len(chunk[n - 1].encode())
        return counts

    def _direct(self, chunk: str) -> int:
        return len(self.library.encode("\n" + chunk)) - self.lead

    def chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def total(self, chunk: str) -> int:
        return self._direct(chunk) if chunk.startswith(MARK * 2) else self.chunk_table(chunk)[-1]

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        total = self.total
        if MARK in text or "  " in text or text[:1] == " " or text[-1:] == " ":
            return sum(map(total, self.chunks(text)))
        # the usual case: single spaces, so chunks are the words with a mark
        known, out = self.words, 0
        for word in text.split(" ") if text else ():
            n = known.get(word)
            if n is None:
                if len(known) >= self.remember:
                    known.clear()
                n = known[word] = self.chunk_table(MARK + word)[-1]
            out += n
        return out

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for every ``i`` from 0 to ``len(text)``."""
        out, done = [0], 0
        for k, chunk in enumerate(self.chunks(text)):
            # the first chunk begins with the mark that is put before a text
            own = self.chunk_table(chunk)[1 + (k == 0):]
            out += [done + n for n in own]
            done = out[-1] if own else done
        return np.array(out, np.int64)

    def cut(self, text: str, budget: int) -> int:
        """The largest ``i`` so that ``text[:i]`` has at most ``budget`` tokens."""
        table = self.prefix_counts(text)
        return int(np.flatnonzero(table <= budget)[-1]) if budget >= 0 else 0


@lru_cache(maxsize=2)
def counter(model_path: str) -> PrefixCounter:
    """One counter a worker: its memories serve all tasks that the worker runs."""
    return PrefixCounter(model_path)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """Per row: ``id_col``, n_bytes, n_tokens and whether n_tokens > ``limit``.

    No shuffle: every task counts its own rows. NULL text: 0 bytes, 0 tokens.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = counter(model_path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            tokens = [tables.count(t) for t in texts]
            yield pd.DataFrame({
                "id": batch["id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": tokens,
                "over_limit": [n > limit for n in tokens]})

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInPandas(
        run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)


def truncated(docs: DataFrame, model_path: str, budget: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Per row the longest prefix of the text of at most ``budget`` tokens
    (``id_col``, text, n_tokens), read off the prefix table."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = counter(model_path)
        for batch in batches:
            kept, tokens = [], []
            for t in batch["text"]:
                table = tables.prefix_counts(t or "")
                at = int(np.flatnonzero(table <= budget)[-1])
                kept.append((t or "")[:at])
                tokens.append(int(table[at]))
            yield pd.DataFrame({"id": batch["id"], "text": kept, "n_tokens": tokens})

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInPandas(
        run, f"id {id_type}, text string, n_tokens long")
    return out.withColumnRenamed("id", id_col)
