"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles (a text of one to four words is one
shingle); two are linked if their sets' Jaccard similarity reaches ``THRESHOLD``.

1. Documents of the same words form one class; its smallest id and the hash of that
   row's text stand for it (``rep``), so texts that share an id stay apart.
2. MinHash values in ``BANDS`` bands of ``ROWS`` make candidates: at similarity
   0.8 a pair shares no band with probability 1e-7. Each band bucket adds one
   edge from every member to its smallest member, never all pairs; connected
   components of these edges hold every candidate pair.
3. A component is cut into blocks of about ``BLOCK`` classes, and a task compares
   two blocks. MinHash values are compared ``STEP`` at a time, and a pair is dropped
   once the posterior probability (uniform prior) of reaching the threshold is
   below ``TOLERANCE``. All that remain are verified on the whole shingle sets.
   A task returns one row for each class: its links, and the smallest class it
   is linked to directly or through others of the task. Pairs are never rows.
4. Connected components of those rows are the result's groups.

Cases: empty and NULL texts are linked to nothing; rows without an id take no
part and get a NULL class and 0 links; rows that repeat id and text count once, and
rows of one id and different texts are documents of their own;
an empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_HASHES, forget_hashes, mix64, remembers, rolling, written

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP = 40, 5, 40
TOLERANCE = 1e-9
BLOCK = 256
#: Edges of a kept round to a file: a file costs each task that writes it a process on a local disk.
FILE_EDGES = 100_000
_hashes = WORD_HASHES


def _multipliers() -> np.ndarray:
    return mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    hashes = _hashes.of(words)
    return np.unique(rolling(hashes, min(SHINGLE, len(words)))) if words else np.empty(0, np.uint64)


def minhash(found: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(found), 512):
        np.minimum(out, (found[lo:lo + 512, None] * factors).min(0), out=out)
    return out


#: A class: its smallest id and that row's text hash; ids come first in its order.
REP = "struct<id:bigint,raw:bigint>"


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, raw, n_words, hash_a, hash_b, bands array<long>) of every text with words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        remembers("hashes", forget_hashes)
        factors = _multipliers()
        place = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for batch in batches:
            rows = []
            for key, raw, text in zip(batch["doc_id"], batch["raw"], batch["text"]):
                words = text.encode().split() if text else []
                if not words:
                    continue
                low = minhash(shingles(words), factors).reshape(BANDS, ROWS)
                key_of = place.copy()
                for r in range(ROWS):
                    key_of = mix64(key_of ^ low[:, r]) + place
                joined = b" ".join(words)
                rows.append((key, raw, len(words), xxhash.xxh3_64_intdigest(joined) - (1 << 63),
                             xxhash.xxh64_intdigest(joined, 7) - (1 << 63), key_of.view(np.int64)))
            yield pd.DataFrame(rows, columns=["doc_id", "raw", "n_words", "hash_a", "hash_b", "bands"])

    return docs.where("doc_id IS NOT NULL").select("doc_id", "raw", "text").mapInPandas(
        run, "doc_id long, raw long, n_words long, hash_a long, hash_b long, bands array<long>")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp): the smallest node of each node's connected component.

    Alternating stars: every node's larger neighbours attach to its smallest,
    then every node's smaller ones do. Only tables of edges move, and each round
    is written to the shared folder, in as many files as its edges need.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
                  name)
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        now = written(small.select("a", F.col("m").alias("b")).unionByName(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
            .coalesce(state.n // FILE_EDGES + 1), name)


def prune_limits() -> list[int]:
    """After ``STEP``, 2 ``STEP``, ... compared values: the fewest equal ones at which the
    posterior probability of a similarity of at least ``THRESHOLD`` is not below ``TOLERANCE``."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid) + lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            if np.exp(log[grid >= THRESHOLD]).sum() / len(grid) >= TOLERANCE:
                out.append(m)
                break
    return out


def candidates(sig_a: np.ndarray, sig_b: np.ndarray, same: bool, limits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that the incremental comparison leaves."""
    equal = (sig_a[:, None, :STEP] == sig_b[None, :, :STEP]).sum(2, dtype=np.int32)
    i, j = np.nonzero(equal >= limits[0])
    if same:
        i, j = i[i < j], j[i < j]
    count = equal[i, j]
    for k, limit in enumerate(limits[1:], 1):
        part = slice(k * STEP, (k + 1) * STEP)
        for lo in range(0, len(i), 50_000):
            at = slice(lo, lo + 50_000)
            count[at] += (sig_a[i[at], part] == sig_b[j[at], part]).sum(1, dtype=np.int32)
        keep = count >= limit
        i, j, count = i[keep], j[keep], count[keep]
    return i, j


def linked(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs reach the threshold exactly."""
    size_a, size_b = (np.array([len(s) for s in x], np.int64) for x in (sets_a, sets_b))
    need = THRESHOLD * np.maximum(size_a[i], size_b[j])
    ok = np.minimum(size_a[i], size_b[j]) >= need - 1e-9
    if len(i) > 200:
        # all at once: products of 0/1 matrices over a slice of the shingles at a time
        rows_a, rows_b = np.unique(i[ok]), np.unique(j[ok])
        if not len(rows_a):
            return ok
        vocab, at = np.unique(np.concatenate([sets_a[r] for r in rows_a] + [sets_b[r] for r in rows_b]), return_inverse=True)
        owner = np.repeat(np.arange(len(rows_a) + len(rows_b)),
                          [len(sets_a[r]) for r in rows_a] + [len(sets_b[r]) for r in rows_b])
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        common = np.zeros((len(rows_a), len(rows_b)), np.float32)
        for lo in range(0, len(vocab), 4096):
            part = slice(*np.searchsorted(at, [lo, lo + 4096]))
            hot = np.zeros((len(rows_a) + len(rows_b), 4096), np.float32)
            hot[owner[part], at[part] - lo] = 1
            common += hot[:len(rows_a)] @ hot[len(rows_a):].T
        both = np.zeros(len(i))
        both[ok] = common[np.searchsorted(rows_a, i[ok]), np.searchsorted(rows_b, j[ok])]
    else:
        both = np.array([len(np.intersect1d(sets_a[x], sets_b[y], True)) if good else 0
                         for x, y, good in zip(i, j, ok)], float)
    return ok & (both >= THRESHOLD * (size_a[i] + size_b[j] - both) - 1e-9)


def smallest_linked(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest id that each of the ids is linked to, directly or through others."""
    low = ids.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        if (new == low).all():
            return low
        low = new


def compared(part: pd.DataFrame, limits: list[int]) -> pd.DataFrame:
    """One task: the classes of one block, or of two (``side`` 0 and 1)."""
    sig = np.stack([np.frombuffer(s, np.uint16) for s in part["sig"]])
    sets = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
    side, copies = part["side"].to_numpy(), part["copies"].to_numpy(np.int64)
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    same = not len(second)
    if same:
        second = first
    i, j = candidates(sig[first], sig[second], same, limits)
    good = linked([sets[x] for x in first], [sets[x] for x in second], i, j) if len(i) else np.empty(0, bool)
    i, j = first[i[good]], second[j[good]]
    ids, raws = part["id"].to_numpy(np.int64), part["raw"].to_numpy(np.int64)
    links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    order = np.lexsort((raws, ids))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    root = order[smallest_linked(place, i, j)]
    return pd.DataFrame({"id": ids, "raw": raws, "links": links.astype(np.int64), "root_id": ids[root], "root_raw": raws[root]})


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row (rows that repeat id and text once): ``id_col``, class_id (the smallest
    id of its group), n_links (other documents it is linked to), rep (the smallest id
    of its exact copies), n_words, text_hash (xxhash64 of its text) and class_hash (that
    of its group's first text: where class_id has many texts, the one that stands for it)."""
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                       F.xxhash64(docs[text_col]).alias("raw"))
    first = F.min(F.struct(F.col("doc_id").alias("id"), "raw")).alias("rep")
    signed = written(signatures(docs), "op5-signatures")
    text = ["hash_a", "hash_b", "n_words"]
    members = signed.select("doc_id", "raw", *text).distinct()
    classes = (members.groupBy("doc_id", *text).agg(F.min("raw").alias("raw"))
               .groupBy(*text).agg(first, F.count("*").alias("copies")))
    # repeated rows of one id and text have one signature: the smallest id's bands stand for the class
    bands = signed.groupBy(*text).agg(first, F.min_by("bands", "doc_id").alias("bands"))
    keys = bands.select("rep", F.explode("bands").alias("key")).distinct()
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub")
    edges = keys.join(hubs, "key").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    comps = components(edges, "op5-candidates")
    sizes = comps.groupBy("comp").agg(F.count("*").alias("size"))
    blocked = (comps.join(sizes, "comp").join(classes.select("rep", "copies"), F.col("node") == F.col("rep"))
               .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
               .select("rep", "copies", "comp", "blocks", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")))

    def with_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembers("hashes", forget_hashes)
        factors = _multipliers()
        for batch in batches:
            found = [shingles(t.encode().split()) for t in batch["text"]]
            yield batch.drop(columns="text").assign(
                sig=[(minhash(s, factors) >> np.uint64(48)).astype(np.uint16).tobytes() for s in found],
                shingles=[s.tobytes() for s in found])

    # small components share tasks; blocks of a large one meet in pairs
    small = max(1, sizes.agg(F.sum("size")).first()[0] or 1) // BLOCK + 1
    blocked = blocked.select(F.col("rep.id").alias("id"), F.col("rep.raw").alias("raw"), "copies",
                             F.col("comp.id").alias("comp"), F.col("comp.raw").alias("comp_raw"), "blocks", "block")
    sets = (docs.withColumnRenamed("doc_id", "id").join(blocked, ["id", "raw"]).dropDuplicates(["id", "raw"])
            .select("id", "raw", "copies", "comp", "comp_raw", "blocks", "block", "text")
            .mapInPandas(with_sets, "id long, raw long, copies long, comp long, comp_raw long, blocks int, block int, "
                                    "sig binary, shingles binary")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("id", "raw", "copies", "comp", "comp_raw", "sig", "shingles",
                    F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp", "comp_raw"), F.lit(small))).otherwise(F.col("comp"))
                    .alias("task"), F.when(F.col("blocks") > 1, F.col("comp_raw")).otherwise(0).alias("task_raw"),
                    (F.col("blocks") > 1).alias("big"), F.least("block", "other").alias("p"),
                    F.greatest("block", "other").alias("q"), (F.col("block") > F.col("other")).cast("int").alias("side")))
    limits = prune_limits()

    def compare(task: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([compared(g.reset_index(drop=True), limits) for _, g in task.groupby(["comp", "comp_raw"])])

    found = written(sets.groupBy("task", "task_raw", "big", "p", "q").applyInPandas(
        compare, "id long, raw long, links long, root_id long, root_raw long").select(
        F.struct("id", "raw").cast(REP).alias("rep"), "links",
        F.struct(F.col("root_id").alias("id"), F.col("root_raw").alias("raw")).cast(REP).alias("root")), "op5-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "op5-groups")
    of_class = (classes.join(links, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
                .select(*text, F.col("rep.id").alias("rep"), F.coalesce("comp", "rep").alias("class"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    with_words = members.join(of_class, text).select(
        "doc_id", F.col("class.id").alias("class_id"), "n_links", "rep", "n_words", F.col("raw").alias("text_hash"),
        F.col("class.raw").alias("class_hash"))
    bare = docs.where("doc_id IS NULL OR text IS NULL OR NOT text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    without = bare.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                          F.col("doc_id").alias("rep"), F.lit(0).cast("long").alias("n_words"),
                          F.col("raw").alias("text_hash"), F.col("raw").alias("class_hash"))
    return with_words.unionByName(without).withColumnRenamed("doc_id", id_col)


SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
       FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
r AS (SELECT a AS doc_id, a AS m FROM l UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.doc_id WHERE r.m < l.b),
g AS (SELECT doc_id, min(m) AS m FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(least(g.m, d.doc_id), d.doc_id) AS class_id,
       (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links
FROM documents d LEFT JOIN g USING (doc_id)
"""
