"""The corpus pipeline over ``documents``: quality, near duplicates, repeated
passages, source mixture, packing. Counted as part of the subpackage ``llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared folder as Parquet and hands the reread rows on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tabsmith.llm import op1_packing as op1
from tabsmith.llm import op4_mixing as op4
from tabsmith.llm import op5_jaccard_join as op5
from tabsmith.llm import op8_substring_dedup as op8
from tabsmith.llm import op10_quality as op10
from tabsmith.llm.common import ship, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    ship(spark)
    model = op10.fit(docs, table(spark, sf_dir, "labels"))
    return op10.scored(docs.select(COLUMNS), model).where("predicted = 1").select(COLUMNS)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near duplicates the document of the smallest id. Rows without
    an id stay; of rows that repeat a kept id and its text one stays, and rows of one id
    and different texts are judged each by its text."""
    ship(spark)
    groups = op5.jaccard_groups(docs)
    kept = groups.where("doc_id = class_id AND text_hash = class_hash").select("doc_id", "text_hash").distinct()
    return (docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash")).join(kept, ["doc_id", "text_hash"])
            .select(COLUMNS).dropDuplicates(["doc_id", "text"])
            .unionByName(docs.where("doc_id IS NULL").select(COLUMNS)).select(COLUMNS))


def repeated_passages(spark, docs, sf_dir):
    """Every document with its kept words, joined by one space."""
    ship(spark)
    kept = op8.deduplicated(docs, keep=["lang", "source"])
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source",
                       F.length("kept").cast("long").alias("n_chars"))


def mixture(spark, docs, sf_dir):
    """Documents repeated so that sources weigh as the square root of their rows, shuffled."""
    ship(spark)
    return op4.mixed(docs, op4.tempered_weights(docs)).select(COLUMNS)


def packing(spark, docs, sf_dir):
    """All copies of all documents, packed into sequences of 4096 tokens."""
    ship(spark)
    return op1.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("mixture", mixture), ("packing", packing)]

#: The classifier's training has no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages in order, from the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
