"""Exact top-k search by MaxScore over vector components as query terms.

A shard of the index keeps one posting list for each component: its values over
the shard's vectors, with the largest and the smallest value. For a query each
term's score bound follows from the two. Terms of small bounds are
non-essential as long as together they cannot lift a vector over the current
k-th score. The essential lists are traversed for all vectors of a block; only
vectors that stay competitive with the bounds of the rest are probed in the
other lists, largest bound first. Results of shards merge by score.

Vectors fall into shards of bounded size and are shuffled once. Queries are dealt to
every shard and stream through its task behind the shard's vectors, one Arrow batch
at a time; a task holds one shard and one batch of queries.

Cases: vectors that are NULL or hold NULL or non-finite components, and rows
without an id, take no part; vectors of unequal length count as padded by 0; every
row but the query's own is a candidate, also one of the query's id: a search takes
one more than k, and one row equal to the query leaves (of equal rows any one is
the query's own); equal query rows are asked once; rows that repeat a query's id
with other vectors are queries of their own, ranked apart under that id; very long
vectors are read whole; components or scores beyond 64 bits are an error; empty tables
give an empty result; columns other than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_VECTORS, CHUNK = 16_384, 4_096


def quantised(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, terms array<long>): floor(scale * x) of every component."""
    ok = F.col("v").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
            .where(ok).select("vec_id", F.transform("v", lambda x: F.when(
                F.abs(x * scale) < float(1 << 63), F.floor(x * scale)).otherwise(
                    F.raise_error(F.lit("a component needs more than 64 bits")).cast("long"))).alias("terms")))


def _matrix(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for row, values in zip(out, lists):
        row[:len(values)] = values
    return out


class Shard:
    """Posting lists of one shard: ``lists[d]`` holds component ``d`` of all vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.lists = ids[order], np.ascontiguousarray(vectors[order].T)
        self.high, self.low = self.lists.max(1), self.lists.min(1)

    def best(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best vectors, ties to smaller ids."""
        top = np.maximum(query * self.high, query * self.low)
        low = np.minimum(query * self.high, query * self.low)
        order = np.argsort(low - top, kind="stable")                   # largest spread of score first
        rest = np.append(np.cumsum(top[order][::-1])[::-1], 0)         # most that terms from here on can add
        spread = np.append(np.cumsum((top - low)[order][::-1])[::-1], 0)
        least, floor_ = -np.inf, low.sum()
        places, scores = np.empty(0, np.int64), np.empty(0, self.lists.dtype)
        for at in range(0, len(self.ids), CHUNK):
            part = slice(at, at + CHUNK)
            # non-essential: all of them together stay under the k-th score
            n = int(np.searchsorted(-spread, -(least - floor_), "right")) if least > -np.inf else len(order)
            n = min(max(n, 1), len(order))
            score = query[order[:n]] @ self.lists[order[:n], part]
            alive = np.flatnonzero(score + rest[n] >= least)
            score = score[alive]
            for d in range(n, len(order)):
                if not len(alive):
                    break
                score = score + query[order[d]] * self.lists[order[d], at + alive]
                keep = score + rest[d + 1] >= least
                if not keep.all():
                    alive, score = alive[keep], score[keep]
            places, scores = np.append(places, at + alive), np.append(scores, score)
            first = np.lexsort((places, -scores))[:k]                  # places are in order of ids
            places, scores = places[first], scores[first]
            if len(places) == k:
                least = scores[-1]
        return places, scores


def _searched(shard: Shard, width: int, batch: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query_id, query, vec_id, score, own) of one batch of queries in one shard."""
    wide = max(width, max(map(len, batch["terms"]), default=0))
    asked = _matrix(batch["terms"], wide)
    spread = np.abs(shard.lists).max(1, initial=0)
    most = float((np.abs(asked[:, :width]) @ spread).max(initial=0))
    if most >= 2.0 ** 63:
        raise OverflowError("a score may need more than 64 bits")
    if most >= 2.0 ** 53 and shard.lists.dtype != np.int64:       # beyond exact floats
        exact = Shard.__new__(Shard)
        exact.ids, exact.lists = shard.ids, shard.lists.astype(np.int64)
        exact.high, exact.low = exact.lists.max(1), exact.lists.min(1)
        shard, asked = exact, asked.astype(np.int64)
    out = []
    for key, number, query in zip(batch["vec_id"], batch["query"], asked):
        places, scores = shard.best(query[:width], k + 1)
        same = shard.ids[places] == key
        if wide > width and query[width:].any():
            same[:] = False
        same[same] = (shard.lists[:, places[same]].T == query[:width]).all(1)
        out.append(pd.DataFrame({"query_id": key, "query": number, "vec_id": shard.ids[places],
                                 "score": scores.astype(np.int64), "own": same}))
    return pd.concat(out)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's ``k`` largest integer inner
    products; both inputs are (vec_id, terms)."""
    shards = max(1, -(-vectors.count() // SHARD_VECTORS))
    columns = ["shard", "asked", "query", "vec_id", "terms"]
    index = (vectors.withColumn("shard", ((F.monotonically_increasing_id() + F.spark_partition_id()) % shards).cast("long"))
             .withColumns({"asked": F.lit(False), "query": F.lit(0).cast("long")}).select(columns))
    # the number tells the vectors of one id apart
    spread = (queries.select("vec_id", "terms").distinct().withColumn("query", F.xxhash64("vec_id", "terms"))
              .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
              .withColumn("asked", F.lit(True)).select(columns))
    parts = min(shards, 10 * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = index.unionByName(spread).repartition(parts, "shard").sortWithinPartitions("shard", "asked")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ids, held, shard, width = None, [], [], None, 0
        for batch in batches:
            for number, rows in batch.groupby("shard", sort=True):
                if number != now:
                    now, ids, held, shard = number, [], [], None
                mine, asked = rows[~rows["asked"]], rows[rows["asked"]]
                ids += mine["vec_id"].tolist()
                held += mine["terms"].tolist()
                if len(asked) and ids:
                    if shard is None:
                        width = max(1, max(map(len, held)))
                        shard = Shard(np.array(ids, np.int64), _matrix(held, width))
                        held = []
                    yield _searched(shard, width, asked, k)

    found = dealt.mapInPandas(run, "query_id long, query long, vec_id long, score long, own boolean")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    # best k + 1 of all shards, less the query's own row; without it the first k
    best = found.withColumn("place", F.row_number().over(order)).where(f"place <= {k + 1}")
    mine = F.min(F.when(F.col("own"), F.col("place"))).over(Window.partitionBy("query_id", "query"))
    return (best.withColumn("mine", F.coalesce(mine, F.lit(k + 1))).where("place <> mine")
            .withColumn("rank", (F.col("place") - (F.col("place") > F.col("mine")).cast("int")).cast("int"))
            .select("query_id", "rank", "vec_id", "score"))


SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS t FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
             CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.t, v.t)]) AS BIGINT) AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 10
"""
