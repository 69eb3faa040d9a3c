"""Mixing sources to target weights by Poisson replication.

A source of weight ``w`` (its share of the mixture) with ``n`` of ``N`` rows has
the mean repetition rate ``w * N / n``. Each document draws its number of copies
by inverting that Poisson distribution at a number hashed from seed and id, so
the draw needs no state and is the same on every run. Copies are then dealt to
partitions and ordered by a second hash: a global shuffle without a sort by range.

The table of sources is broadcast only if it has at most ``BROADCAST_SOURCES``
rows; beyond that it is an ordinary join.

Cases: rows without a source are a source of their own; rows that repeat an id
draw the same number; NULL ids draw as empty text; a source whose weight is
missing, NULL or not above 0 gets no copies; an empty table gives an empty
result; an input column named like one of the operator's own is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_SOURCES = 100_000


def hashed(seed: str, *parts) -> Column:
    """32 hex digits from seed and parts, the same in any engine that has md5."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def unit(hex_digits: Column) -> Column:
    """A number above 0 and below 1 from 52 hashed bits."""
    return (F.conv(F.substring(hex_digits, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def tempered_weights(docs: DataFrame, power: float = 0.5, source_col: str = "source") -> DataFrame:
    """(source, weight): shares in proportion to rows ** ``power``."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum(F.pow("n", F.lit(power)))).first()[0] or 1.0
    return counts.select("source", (F.pow("n", F.lit(power)) / total).alias("weight"))


def repetition_rates(docs: DataFrame, weights: DataFrame, source_col: str = "source") -> DataFrame:
    """(source, rate, steps): steps[k] is the probability of at most k copies."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    rates = (counts.alias("c").join(weights.alias("w"), F.col("c.source").eqNullSafe(F.col("w.source")))
             .where("w.weight > 0").select("c.source", (F.col("weight") * total / F.col("n")).alias("rate")))
    # far enough that what lies beyond is smaller than the distance of two hashed numbers
    # both sums are carried along, not taken again for every k
    carried = ("aggregate({items}, named_struct('s', 0D, 'out', {start}), (a, y) -> named_struct('s', a.s + {add}, "
               "'out', concat(a.out, array(a.s + {add}))), a -> a.out)")
    return (rates.withColumn("log_fact", F.expr(carried.format(
                items="sequence(1, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS INT))", start="array(0D)", add="ln(y)")))
            .withColumn("p", F.expr("transform(log_fact, (f, k) -> exp(k * ln(rate) - rate - f))"))
            .withColumn("steps", F.expr(carried.format(items="p", start="CAST(array() AS ARRAY<DOUBLE>)", add="y")))
            .select("source", "rate", "steps"))


def mixed(docs: DataFrame, weights: DataFrame, seed: str = "mix", id_col: str = "doc_id",
          source_col: str = "source", partitions: int | None = None) -> DataFrame:
    """All columns of ``docs`` with copy (from 1) and n_copies, globally shuffled."""
    keep = [c for c in docs.columns if c not in ("copy", "n_copies")]
    rates = repetition_rates(docs, weights, source_col)
    rates = rates.withColumnRenamed("source", "_source").select("_source", "steps")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    drawn = (docs.select(*keep).join(rates, docs[source_col].eqNullSafe(F.col("_source")))
             .withColumn("_u", unit(hashed(seed, F.col(id_col))))
             .withColumn("n_copies", F.expr("size(filter(steps, s -> s <= _u))")).where("n_copies > 0")
             .withColumn("copy", F.explode(F.expr("sequence(1, n_copies)")))
             .withColumn("_order", hashed(seed + "|order", F.col(id_col), F.col("copy"))))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (drawn.select(*keep, "copy", "n_copies", "_order").repartition(n, "_order")
            .sortWithinPartitions("_order").drop("_order"))


#: DuckDB SQL of the mixture at tempered weights (power 0.5, seed "mix").
TEMPERED_SQL = """
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS total, sum(pow(n, 0.5)) AS roots FROM c),
r AS (SELECT source, (pow(n, 0.5) / roots) * total / n AS rate FROM c, t),
p AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
      FROM r, LATERAL (SELECT unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k)),
s AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS step FROM p),
d AS (SELECT *, (CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
             / 4503599627370496.0 AS u FROM documents),
m AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.u, count(*) AS n_copies
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source AND s.step <= d.u GROUP BY ALL)
"""
