"""Substring dedup: a De Bruijn graph of the repeated words, compacted to paths.

An edge is a run of ``window`` words, from the node of its first ``window - 1`` words
to the node of its last. An edge that starts in two or more documents is repeated,
and only repeated edges enter the graph:

1. *Anchors.* Of the short runs inside an edge, the one with the smallest hash
   stands for it. Equal edges have equal anchors, so an edge can be repeated
   only if its anchor occurs in two documents of different text. The anchors of a
   document (about 2 in 36 words) are counted; exact copies of whole
   documents are settled by their whole-text hash.
2. *Edges.* Edges over a repeated anchor are hashed with their end nodes, and written
   as runs of neighbours; the smallest (doc_id, position) of each repeated
   edge is its source coordinate.
3. *Degrees.* Each repeated edge is joined to its two nodes. A node with two
   different edges in, or two out, is a branch.
4. *Compaction.* Edges whose sources follow one another, with no branch between them,
   make one path, named by the source coordinate of its first edge. So a path
   is cut at every branch and where the source changes. Where a document
   walks along a path, its edges compact into one span (document, starts, length,
   source document, source start).
5. *Verification.* Each distinct source span is read from its document, and words
   go only where the span's own words have the same SHA-256: a hash collision
   never removes a word (of nodes it can at most cut a path).

Cases: NULL text has no words; documents of fewer words than a window keep all;
rows with NULL ids neither remove words nor lose any; rows that repeat an id
are not each other's copies (no id is smaller), and each gets its own row, judged by
its own text (``twin`` tells the texts of one id apart all the way);
columns other than id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_HASHES, dropped, forget_hashes, remembers, rolling, written

ANCHOR = 16   # words of an anchor
#: Key of rows without an id in joins; such rows take no other part.
NO_ID = -(1 << 63)
_hashes = WORD_HASHES


def raw():
    """Hash of the text as it stands, also before it reaches Python."""
    return F.xxhash64("text").alias("raw")


def parts(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """The batches in pieces of ``rows``: what a task holds beside a batch of texts stays small."""
    for batch in batches:
        for lo in range(0, len(batch), rows):
            yield batch.iloc[lo:lo + rows]


def words_of(text: str | None) -> list[bytes]:
    """``bytes.split`` splits at exactly the six ASCII white-space characters."""
    return text.encode().split() if text else []


def anchor_of_edges(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every edge the smallest hash among its runs of ``ANCHOR`` words."""
    low = rolling(hashes, min(ANCHOR, window))
    left, span = window - min(ANCHOR, window) + 1, 1
    while span * 2 <= left:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = left - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, raw, text_hash, n_words, anchors) of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembers("hashes", forget_hashes)
        for batch in batches:
            found, whole, sizes = [], [], []
            for text in batch["text"]:
                words = words_of(text)
                n, own = len(words), np.empty(0, np.uint64)
                if n >= window:
                    hashes = _hashes.of(words)
                    own = np.unique(anchor_of_edges(hashes, window))
                    whole.append(rolling(hashes, n)[0])
                else:
                    whole.append(0)
                found.append(own.view(np.int64))
                sizes.append(n)
            long = np.array(sizes, np.int64) >= window
            out = pd.DataFrame({"doc_id": batch["key"].to_numpy(np.int64), "raw": batch["raw"].to_numpy(np.int64),
                                "text_hash": np.array(whole, np.uint64).view(np.int64), "n_words": sizes, "anchors": found})
            yield out[long]

    return docs.where(f"key > {NO_ID}").select("key", "text", raw()).mapInPandas(
        run, "doc_id long, raw long, text_hash long, n_words long, anchors array<long>")


def edge_runs(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(doc_id, twin, start, edges, nodes): the edges of ``docs`` over an anchor that
    ``wanted`` (key, raw, twin, anchors) lists for its text, one row for each run of
    neighbours; node i and node i + 1 are the ends of edge i."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembers("hashes", forget_hashes)
        for part in parts(batches):
            out = []
            for key, twin, text, own in zip(part["key"], part["twin"], part["text"], part["anchors"]):
                hashes = _hashes.of(words_of(text))
                if len(hashes) < window:
                    continue
                at = np.flatnonzero(np.isin(anchor_of_edges(hashes, window),
                                            np.asarray(own, np.int64).view(np.uint64)))
                edge, node = rolling(hashes, window).view(np.int64), rolling(hashes, window - 1).view(np.int64)
                for run_ in np.split(at, np.flatnonzero(np.diff(at) != 1) + 1):
                    if len(run_):
                        a, b = int(run_[0]), int(run_[-1]) + 1
                        out.append((key, twin, a, edge[a:b], node[a:b + 1]))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "twin", "start", "edges", "nodes"])

    return (docs.withColumn("raw", raw()).join(wanted, ["key", "raw"]).select("key", "text", "twin", "anchors")
            .mapInPandas(run, "doc_id long, twin long, start long, edges array<long>, nodes array<long>"))


def sources(runs: DataFrame) -> DataFrame:
    """(edge, src_doc, src_twin, src_pos, path): every repeated edge at its source, and
    the first source position of its path.

    The graph: in- and out-degrees are counted by node; a path goes on from edge to edge
    of one source while the node between them is no branch.
    """
    each = runs.select("doc_id", "twin", "start", F.posexplode(F.arrays_zip(
        "edges", F.slice("nodes", 1, F.size("edges")).alias("from"), F.slice("nodes", 2, F.size("edges")).alias("to"))).alias("i", "e"))
    first = (each.select(F.col("e.edges").alias("edge"), "doc_id",
                         F.struct("doc_id", "twin", (F.col("start") + F.col("i")).alias("pos"), "e.from", "e.to").alias("at"))
             .groupBy("edge").agg(F.min("at").alias("at"), F.max("doc_id").alias("last")).where("last > at.doc_id")
             .select("edge", "at.*"))
    first = written(first, "op8-first")
    ends = first.select("edge", F.explode(F.array(
        F.struct(F.col("from").alias("node"), F.lit(True).alias("out")),
        F.struct(F.col("to").alias("node"), F.lit(False).alias("out")))).alias("n")).select("n.node", *[
            F.when(F.col("n.out") == side, F.col("edge")).alias(name) for side, name in ((True, "leaving"), (False, "entering"))])
    branch = (ends.groupBy("node").agg(*[f(c).alias(f"{n}_{c}") for c in ("leaving", "entering")
                                         for n, f in (("low", F.min), ("high", F.max))])
              .where("low_leaving <> high_leaving OR low_entering <> high_entering")
              .select(F.col("node").alias("from"), F.lit(True).alias("branch")))
    order = Window.partitionBy("doc_id", "twin").orderBy("pos")      # the edges of one document
    starts = F.col("branch").isNotNull() | ~F.col("pos").eqNullSafe(F.lag("pos").over(order) + 1)
    return (first.join(branch, "from", "left").withColumn("starts", F.when(starts, F.col("pos")))
            .select("edge", F.col("doc_id").alias("src_doc"), F.col("twin").alias("src_twin"), F.col("pos").alias("src_pos"),
                    F.last("starts", ignorenulls=True).over(order).alias("path")))


SPAN = ["doc_id", "twin", "starts", "length", "src_doc", "src_twin", "src_start"]


def compacted(matched: DataFrame, window: int) -> DataFrame:
    """Walks along a path: (doc_id, twin, starts, length, src_doc, src_twin, src_start).

    Along a path the position and the source position grow together, so
    position minus rank is the same for all its edges. A text that repeats itself
    goes round a cycle of the graph: the same source path then stands at many
    places of the document, which are kept as one row with all its starts.
    """
    walk = ["doc_id", "twin", "src_doc", "src_twin", "shift", "path"]
    order = Window.partitionBy(*walk).orderBy("pos")
    return (matched.withColumn("shift", F.col("pos") - F.col("src_pos"))
            .withColumn("walk", F.col("pos") - F.dense_rank().over(order))
            .groupBy(*walk, "walk")
            .agg(F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + window).alias("length"))
            .groupBy("doc_id", "twin", "src_doc", "src_twin", (F.col("start") - F.col("shift")).alias("src_start"), "length")
            .agg(F.collect_list("start").alias("starts")).select(*SPAN))


def source_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(src_doc, src_twin, src_start, length, sha): what stands at each source coordinate."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches):
            rows = []
            for key, own, text, asked in zip(batch["key"], batch["raw"], batch["text"], batch["asked"]):
                words = words_of(text)
                rows += [(key, a["src_twin"], a["src_start"], a["length"],
                          _sha(words[a["src_start"]:a["src_start"] + a["length"]]))
                         for a in asked if a["src_twin"] in (0, own) and a["src_start"] + a["length"] <= len(words)]
            yield pd.DataFrame(rows, columns=["src_doc", "src_twin", "src_start", "length", "sha"])

    asked = (spans.select("src_doc", "src_twin", "src_start", "length").distinct().groupBy(F.col("src_doc").alias("key"))
             .agg(F.collect_list(F.struct("src_twin", "src_start", "length")).alias("asked")))
    return docs.join(asked, "key").select(*docs.columns, raw(), "asked").mapInPandas(
        run, "src_doc long, src_twin long, src_start long, length long, sha binary").distinct()


def _sha(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def dedup_spans(docs: DataFrame, shuffled: DataFrame, window: int) -> DataFrame:
    """Verified spans to remove, grouped: (key, spans array<struct<starts, length, sha>>).
    ``docs``: key, text, and columns to carry; ``shuffled``: the same rows by key."""
    found = written(anchors(docs, window), "op8-anchors")
    repeated = (found.select(F.explode("anchors").alias("anchor"), "raw").groupBy("anchor")
                .agg(F.min("raw").alias("a"), F.max("raw").alias("b")).where("a <> b").select("anchor"))
    members = found.select("doc_id", "text_hash", "n_words", "raw").distinct()
    # 0 for the text of an id that has one, which is nearly every row
    twins = (members.groupBy("doc_id").agg(F.min("raw").alias("a"), F.max("raw").alias("b"))
             .select("doc_id", (F.col("a") != F.col("b")).alias("many")))
    members = members.join(twins, "doc_id").select(
        "doc_id", "text_hash", "n_words", "raw", F.when(F.col("many"), F.col("raw")).otherwise(F.lit(0)).alias("twin"))
    firsts = (members.groupBy("text_hash", "n_words")
              .agg(F.min(F.struct("doc_id", "twin")).alias("src"), F.count("*").alias("n")))
    copies = (members.join(firsts.where("n > 1"), ["text_hash", "n_words"]).where("doc_id > src.doc_id")
              .select("doc_id", "twin", F.array(F.lit(0).cast("long")).alias("starts"), F.col("n_words").alias("length"),
                      F.col("src.doc_id").alias("src_doc"), F.col("src.twin").alias("src_twin"),
                      F.lit(0).cast("long").alias("src_start"), "raw"))
    copies = written(copies, "op8-copies")
    # only the copied text leaves the search, not the other texts of its id
    wanted = (found.select("doc_id", "raw", F.explode("anchors").alias("anchor")).join(repeated, "anchor")
              .groupBy("doc_id", "raw").agg(F.collect_set("anchor").alias("anchors"))
              .join(copies, ["doc_id", "raw"], "left_anti")
              .join(members.select("doc_id", "raw", "twin"), ["doc_id", "raw"]).withColumnRenamed("doc_id", "key"))
    # both sides of the join below come from written tables, so a very frequent edge
    # is split over tasks; its source is found from partial minima
    runs = written(edge_runs(docs, wanted, window), "op8-edges")
    dropped(found)
    source = written(sources(runs), "op8-sources")
    every = runs.select("doc_id", "twin", F.posexplode("edges").alias("i", "edge"), "start").select(
        "doc_id", "twin", (F.col("start") + F.col("i")).alias("pos"), "edge")
    matched = (every.join(source, "edge").where("doc_id > src_doc")
               .select("doc_id", "twin", "pos", "src_doc", "src_twin", "src_pos", "path"))
    spans = compacted(matched, window).unionByName(copies.select(*SPAN))
    checked = spans.join(source_spans(shuffled, spans), ["src_doc", "src_twin", "src_start", "length"])
    # a span holds for every text of its id that has the source's words at its place
    return checked.groupBy(F.col("doc_id").alias("key")).agg(
        F.collect_list(F.struct("starts", "length", "sha")).alias("spans"))


def deduplicated(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text",
                 partitions: int | None = None, keep: tuple | list = ()) -> DataFrame:
    """Every row's ``id_col``, the columns ``keep``, n_words, n_removed and its kept
    words as ``kept`` (joined by one space).

    A word goes if an edge of ``window`` words that covers it also starts in a
    row of smaller id, judged on the input.
    """
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    keep = [c for c in keep if c not in ("n_words", "n_removed", "kept", id_col)]
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("key"), docs[text_col].alias("text"),
                        *[docs[c].alias(f"_{i}") for i, c in enumerate(keep)])
    # sources and documents read the same columns of the same shuffle, so it runs once
    keyed = plain.repartition(n, "key")
    spans = dedup_spans(plain, keyed, window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches):
            rows = []
            for key, text, own in zip(batch["key"], batch["text"], batch["spans"]):
                words = words_of(text)
                gone = np.zeros(len(words), bool)
                for span in own if own is not None and key != NO_ID else ():
                    for start in span["starts"]:
                        at = slice(start, start + span["length"])
                        if _sha(words[at]) == span["sha"]:
                            gone[at] = True
                kept = [w for w, g in zip(words, gone) if not g] if gone.any() else words
                rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"], index=batch.index)
            yield batch.drop(columns=["text", "spans"]).join(out)

    extra = "".join(f", _{i} {fields[c]}" for i, c in enumerate(keep))
    out = keyed.join(spans, "key", "left").select(*keyed.columns, "spans").mapInPandas(
        run, f"key long{extra}, n_words long, n_removed long, kept string")
    return out.select(F.when(F.col("key") != NO_ID, F.col("key")).cast(fields[id_col]).alias(id_col),
                      *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_removed", "kept")


SQL = """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
e AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
      FROM d, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS i) WHERE len(w) >= 50),
f AS (SELECT h, min(doc_id) AS first FROM e GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
g AS (SELECT e.doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS gone FROM e JOIN f ON e.h = f.h AND e.doc_id > f.first GROUP BY 1),
k AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g ON d.doc_id = g.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256 FROM k
"""
