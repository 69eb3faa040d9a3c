"""Ranked lexical search by the Best Position Algorithm.

A document's score for an item is the sum over the item's terms of an impact: the
term's weight times a saturated, length-normalised count, all in integers.

1. *Postings.* One pass over the texts keeps, for every document, its number of terms
   and the counts of those terms that items hold. It is written to the shared folder.
   Document count, total length and document frequencies are aggregated from it.
2. *Lists.* A task reads its documents in shards of about ``SHARD`` postings. For
   every term a shard has one list of (impact, document), highest impact first.
3. *Best positions.* For an item, its lists are read from the top in parallel. Each
   new document is looked up at once in all the item's lists (direct access), which
   gives its whole score and its positions there. A list's best position is the
   last one up to which every position has been seen, by either kind of access; a
   document not yet seen stands below it in every list. So the sum of the impacts
   at the best positions bounds what is still unseen, and is at most the sum at
   the positions last read. Reading stops when it is strictly below the item's kth
   score (ties go by id, so an equal score might still count), or at the lists' ends.
   The kth score is carried from shard to shard of a task; a shard whose list heads
   sum to less is not read at all.
4. *Merge.* Tasks send their best k of every item; they are merged in salted parts, and
   then as a whole.

Items come in blocks of about ``BLOCK_CHARS`` characters, by a hash; what a block sends
to the tasks is bounded by that, and each block is one pass over the documents.

Cases: NULL text and text without terms take no part and count nowhere; an item
without terms has no rows; rows that repeat an item's id and text are one item,
different texts under one id are items of their own; rows that repeat a document's
id are documents of their own, and may both be ranked; a document without an id is
ranked, after all ids of equal score; very long texts are read whole (a document's
postings are at most the block's terms); empty tables give an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .op1_packing import groups

#: Postings of a shard, about: 50 MB of arrays.
SHARD = 1_500_000
#: Characters of the items of one block, about.
BLOCK_CHARS = 4_000_000
#: Positions read from every list in the first step; each later step reads twice as many.
FIRST_STEP = 32
#: Parts in which the tasks' best documents of one item are merged first.
MERGE_SALTS = 64

#: ASCII letters and digits and all bytes from 0x80 on make terms; only A-Z change case.
_TERM_BYTES = bytes(ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() and b < 0x80 else 0x20 for b in range(128)) + bytes(range(128, 256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split() if text else []


class _Vocabulary(dict):
    """term -> its number, -1 for others."""

    def __missing__(self, term: bytes) -> int:
        return -1


def postings(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n, terms, counts) of every document that has a term: ``n`` terms with
    repeats, and the numbers and counts of its terms of the vocabulary."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = _Vocabulary((t, i) for i, t in enumerate(vocabulary))
        width = len(vocabulary) + 1
        for batch in batches:
            keys = batch["key"].astype(object).where(batch["key"].notna(), None)
            texts = [t or "" for t in batch["text"]]
            for part in groups(texts):
                words = [terms_of(t) for t in texts[part]]
                sizes = np.array([len(w) for w in words], np.int64)
                found = np.fromiter((i for w in words for i in map(number.__getitem__, w)), np.int64, int(sizes.sum()))
                doc = np.repeat(np.arange(len(sizes)), sizes)
                pair, count = np.unique((doc * width + found)[found >= 0], return_counts=True)
                cuts = np.searchsorted(pair, np.arange(1, len(sizes)) * width)
                out = pd.DataFrame({"key": keys.iloc[part].to_numpy(), "n": sizes,
                                    "terms": np.split((pair % width).astype(np.int32), cuts),
                                    "counts": np.split(count.astype(np.int32), cuts)})
                yield out[out["n"] > 0].astype({"key": "Int64"})

    return docs.select(docs[id_col].cast("long").alias("key"), docs[text_col].alias("text")).mapInPandas(
        run, "key long, n long, terms array<int>, counts array<int>")


class Shard:
    """Impact lists of one shard, and direct access to them by document and term."""

    def __init__(self, keys: list, n: np.ndarray, terms: list, counts: list, weights: np.ndarray, total: int, length: int):
        # by id, ids that are NULL last: a smaller number wins a tie
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0))
        self.keys = [keys[i] for i in order]
        sizes = np.array([len(terms[i]) for i in order], np.int64)
        doc = np.repeat(np.arange(len(order)), sizes)
        term = np.concatenate([terms[i] for i in order]).astype(np.int64) if order else np.empty(0, np.int64)
        tf = np.concatenate([counts[i] for i in order]).astype(np.int64) if order else np.empty(0, np.int64)
        norm = 100 - 90 + (90 * np.asarray(n, np.int64)[order] * total) // length
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[doc]))
        self.width = len(weights)
        #: Sorted by document, then term: a direct access is a binary search.
        self.address = doc * self.width + term
        by_list = np.lexsort((-impact, term))
        self.place = np.empty(len(term), np.int64)
        self.place[by_list] = np.arange(len(term))
        self.doc, self.impact = doc[by_list], impact[by_list]
        self.bounds = np.searchsorted(term[by_list], np.arange(self.width + 1))
        self._seen_place, self._seen_doc = np.zeros(len(term), bool), np.zeros(len(order), bool)

    def direct(self, docs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole scores of ``docs`` over ``terms`` (sorted), and their positions."""
        asked = (docs[:, None] * self.width + terms).ravel()
        at = np.searchsorted(self.address, asked)
        at[at == len(self.address)] = 0
        there = self.address[at] == asked
        places = self.place[at]
        return np.where(there, self.impact[places], 0).reshape(len(docs), -1).sum(1), places[there]

    def search(self, terms: np.ndarray, best: list, k: int) -> tuple[list, int]:
        """``best`` (up to k tuples, a min-heap of (score, -order, key)) with this shard's
        documents, and the number of positions read in order."""
        terms = terms[(self.bounds[terms + 1] > self.bounds[terms])]
        terms = terms[self.impact[self.bounds[terms]] > 0] if len(terms) else terms
        if not len(terms):
            return best, 0
        heads, ends = self.bounds[terms], self.bounds[terms + 1]
        if len(best) == k and self.impact[heads].sum() < best[0][0]:
            return best, 0
        next_unseen = heads.copy()
        marked, visited, depth, step, read = [], [], 0, FIRST_STEP, 0
        while True:
            lo, hi = np.minimum(heads + depth, ends), np.minimum(heads + depth + step, ends)
            at = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange(int((hi - lo).sum()))
            read += len(at)
            docs = np.unique(self.doc[at])
            docs = docs[~self._seen_doc[docs]]
            for part in np.array_split(docs, max(1, len(docs) * len(terms) // 2_000_000)):
                if len(part):
                    scores, places = self.direct(part, terms)
                    self._seen_doc[part] = True
                    self._seen_place[places] = True
                    marked.append(places)
                    visited.append(part)
                    self._offer(best, k, part, scores)
            for j in range(len(terms)):
                rest = self._seen_place[next_unseen[j]:ends[j]]
                if len(rest):
                    i = int(rest.argmin())
                    next_unseen[j] = ends[j] if rest[i] else next_unseen[j] + i
            depth, step = depth + step, step * 2
            # at the best positions; a list seen to its end holds no unseen document
            bound = int(self.impact[next_unseen[next_unseen < ends] - 1].sum())
            if (len(best) == k and bound < best[0][0]) or (hi == ends).all():
                break
        self._seen_place[np.concatenate(marked)] = False
        self._seen_doc[np.concatenate(visited)] = False
        return best, read

    def _offer(self, best: list, k: int, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores > 0
        if len(best) == k:
            good &= scores >= best[0][0]
        docs, scores = docs[good], scores[good]
        if len(docs) > k:
            first = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[first], scores[first]
        for d, s in zip(docs.tolist(), scores.tolist()):
            key = self.keys[d]
            one = (s, key is not None, -(key or 0), key)
            if len(best) < k:
                heapq.heappush(best, one)
            elif one[:3] > best[0][:3]:
                heapq.heapreplace(best, one)


def searched(found: DataFrame, items: list[np.ndarray], weights: np.ndarray, total: int, length: int, k: int) -> DataFrame:
    """(item, doc, score): the best k documents of every item in every task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[list] = [[] for _ in items]
        held: list[tuple] = []

        def search() -> None:
            shard = Shard([h[0] for h in held], np.array([h[1] for h in held]), [h[2] for h in held],
                          [h[3] for h in held], weights, total, length)
            for i, terms in enumerate(items):
                best[i], _ = shard.search(terms, best[i], k)
            held.clear()

        size = 0
        for batch in batches:
            keys = batch["key"].astype(object).where(batch["key"].notna(), None)
            for row in zip(keys, batch["n"], batch["terms"], batch["counts"]):
                held.append(row)
                size += len(row[2])
                if size >= SHARD:
                    search()
                    size = 0
        if held:
            search()
        rows = [(i, key, s) for i, own in enumerate(best) for s, _, _, key in own]
        yield pd.DataFrame(rows, columns=["item", "doc", "score"]).astype({"item": "int64", "doc": "Int64", "score": "int64"})

    return found.where(F.size("terms") > 0).mapInPandas(run, "item long, doc long, score long")


def top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(``item_id``, rank, ``id_col``, score): the best k documents of every item."""
    spark = docs.sparkSession
    kinds = items.schema[item_id].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    asked = items.select(items[item_id].alias("item_id"), items[item_text].alias("text")).where("text IS NOT NULL").distinct()
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    out = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()   # about BLOCK_CHARS
        sets = [sorted(set(terms_of(r["text"]))) for r in own]
        vocabulary = sorted({t for s in sets for t in s})
        number = {t: i for i, t in enumerate(vocabulary)}
        found = written(postings(docs, vocabulary, id_col, text_col), "op11-postings")
        whole = found.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
        counts = np.zeros(len(vocabulary), np.int64)
        for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():   # the block's terms
            counts[r["t"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * whole["docs"] + 2) / (2 * c + 1))) for c in counts.tolist()], np.int64)
        lists = [np.array([number[t] for t in s], np.int64) for s in sets]
        part = searched(found, lists, weights, whole["docs"], whole["length"] or 1, k)
        part = top(part.withColumn("salt", F.spark_partition_id() % MERGE_SALTS), ["item", "salt"], k)
        part = top(part.select("item", "doc", "score"), ["item"], k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item long, item_id {kinds[0]}")
        part = part.join(F.broadcast(names), "item")   # one row an item of the block
        part = part.select(F.col("item_id").alias(item_id), F.col("rank"), F.col("doc").cast(kinds[1]).alias(id_col), "score")
        out = part if out is None else out.unionByName(part)
    return out


SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
p AS (SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
      FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, n_docs),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
c AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY 1, 2, 3),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
