"""Document fingerprints: threshold-scaled sketches, in built-in expressions only.

A sketch keeps every shingle hash below a fixed fraction of the hash space, so
its size follows the text and sketches of very unequal texts still estimate
containment; the union of two sketches is the sketch of the union. Texts with
fewer than ``LEAST`` such hashes keep their ``LEAST`` smallest: their sketch is
complete up to its largest hash, and of texts with fewer than ``LEAST`` shingles it
is the whole set. Two sketches are compared up to the bound both are complete to.

Shingles are runs of five words (a text of one to four words is one shingle);
hashes are the upper 32 bits of xxhash64.

Cases: NULL counts as the empty text, whose sketch is empty; two empty sketches
are alike (1); rows that repeat an id follow each other in the order of their
texts; NULL ids come first; an empty table gives an empty result; columns other
than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 1 / 8
LEAST = 32
SPACE = 1 << 32
BELOW = int(SPACE * FRACTION)
#: Rows of one bucket of neighbouring ids, and most buckets (their bounds go through the driver).
BUCKET_ROWS, MOST_BUCKETS = 4_000, 50_000


def with_sketch(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """``df`` with the sorted sketch of ``text_col`` as array<long>."""
    w, h, b = f"_{out_col}_w", f"_{out_col}_h", f"_{out_col}_b"
    return (df.withColumn(w, F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda x: x != ""))
            .withColumn(h, F.expr(
                f"CASE WHEN size({w}) = 0 THEN CAST(array() AS ARRAY<BIGINT>) "
                f"WHEN size({w}) < {SHINGLE} THEN array(shiftrightunsigned(xxhash64(array_join({w}, ' ')), 32)) "
                f"ELSE transform(sequence(1, size({w}) - {SHINGLE - 1}), "
                f"i -> shiftrightunsigned(xxhash64(array_join(slice({w}, i, {SHINGLE}), ' ')), 32)) END"))
            .withColumn(b, F.expr(f"sort_array(array_distinct(filter({h}, x -> x < {BELOW})))"))
            .withColumn(out_col, F.expr(
                f"IF(size({b}) >= {LEAST}, {b}, slice(sort_array(array_distinct({h})), 1, {LEAST}))"))
            .drop(w, h, b))


def complete_to(sketch: str) -> str:
    """SQL of the bound up to which a sketch holds every hash of its text."""
    return f"IF(size({sketch}) < {LEAST}, {SPACE}L, greatest({BELOW - 1}L, element_at({sketch}, -1)))"


def likeness(df: DataFrame, a: str, b: str, out_col: str, containment: bool = False) -> DataFrame:
    """Estimated Jaccard likeness of the sketches ``a`` and ``b``; with
    ``containment`` the share of ``a``'s shingles that ``b`` has."""
    lo, x, y, n = (f"_{out_col}_{k}" for k in "lxyn")
    whole = f"size({x})" if containment else f"(size({x}) + size({y}) - {n})"
    return (df.withColumn(lo, F.expr(f"least({complete_to(a)}, {complete_to(b)})"))
            .withColumn(x, F.expr(f"filter({a}, h -> h <= {lo})")).withColumn(y, F.expr(f"filter({b}, h -> h <= {lo})"))
            .withColumn(n, F.expr(f"size(array_intersect({x}, {y}))"))
            .withColumn(out_col, F.expr(f"IF({whole} = 0, 1D, {n} / {whole})"))
            .drop(lo, x, y, n))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together (for sketches without padding)."""
    return F.array_sort(F.array_union(a, b))


def as_text(sketch: str) -> Column:
    """Eight hex digits for each hash, in order."""
    return F.expr(f"array_join(transform({sketch}, h -> lpad(lower(hex(h)), 8, '0')), '')")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): the row of the next larger id,
    after the last the first.

    Ids fall into buckets of neighbours at approximate quantiles. The first row
    of each bucket is also dealt to the bucket before, behind that bucket's last,
    so the next row is found within a bucket and texts are shuffled once.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    stats = docs.agg(F.count("*").alias("n"), F.min(key).alias("first")).first()
    count = max(1, min(MOST_BUCKETS, -(-stats["n"] // BUCKET_ROWS)))
    bounds = []
    if count > 1:
        # the probabilities are one string of the plan, not a literal each
        share = ",".join(f"{i / count:.9g}" for i in range(1, count))
        cuts = docs.select(key.alias("k")).agg(F.expr(
            f"percentile_approx(k, CAST(split('{share}', ',') AS ARRAY<DOUBLE>), {20 * count})")).first()[0]
        bounds = sorted(set(cuts) - {stats["first"]})
    starts, last = [stats["first"] if stats["first"] is not None else 0, *bounds], len(bounds)
    # binary search: the number of starts up to the id, less one
    steps = [1 << k for k in reversed(range(max(1, len(starts).bit_length())))]
    padded = starts + [(1 << 63) - 1] * (sum(steps) + 1 - len(starts))
    at = F.expr("aggregate(_steps, 0, (lo, s) -> IF(_key >= element_at(_starts, lo + s + 1) AND lo + s < _size, lo + s, lo))")
    # one row of at most MOST_BUCKETS numbers, read by every task instead of standing in the plan
    bounds_row = docs.sparkSession.createDataFrame([(steps, padded, len(starts))], "_steps array<int>, _starts array<long>, _size int")
    dealt = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("_key"))
             .crossJoin(F.broadcast(bounds_row))
             .withColumn("_b", at)
             .withColumn("_first", F.expr("_key = element_at(_starts, _b + 1)"))
             .withColumn("_place", F.explode(F.when(F.col("_first"), F.array(
                 F.struct(F.col("_b").alias("bucket"), F.lit(0).alias("guest")),
                 F.struct(F.when(F.col("_b") == 0, last).otherwise(F.col("_b") - 1).alias("bucket"),
                          F.lit(1).alias("guest"))))
                 .otherwise(F.array(F.struct(F.col("_b").alias("bucket"), F.lit(0).alias("guest"))))))
             .select("doc_id", "text", F.col("_place.bucket").alias("bucket"), F.col("_place.guest").alias("guest")))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketched = with_sketch(dealt.repartition(partitions, "bucket"), "text", "sketch")
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    return (sketched.withColumn("next_text", F.lead("text").over(order))
            .withColumn("next_sketch", F.lead("sketch").over(order))
            .where("guest = 0").drop("bucket", "guest"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (see the module for edited text and likeness)."""
    df = with_next(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")))
    df = (df.withColumn("n_chars", F.length("text").cast("long"))
          .withColumn("_half", F.floor(F.col("n_chars") / 2).cast("int"))
          .withColumn("_edited", F.expr("concat(left(text, CAST(n_chars AS INT) - _half), left(next_text, _half))"))
          .withColumn("edited_sha256", F.sha2("_edited", 256)))
    df = with_sketch(df.drop("text", "next_text"), "_edited", "edited_sketch").drop("_edited")
    df = likeness(likeness(df, "sketch", "edited_sketch", "near_edited"), "sketch", "next_sketch", "near_next")
    return df.select(F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", as_text("sketch").alias("fingerprint"),
                     as_text("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next")
