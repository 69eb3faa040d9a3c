"""One query for each operator, over its whole table with production parameters.

``QUERIES``: name -> function of (spark, sf_dir); ``ORACLE_SQL``: DuckDB SQL
where SQL expresses the result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import op1_packing as op1
from . import op2_topk_search as op2
from . import op3_token_counts as op3
from . import op4_mixing as op4
from . import op5_jaccard_join as op5
from . import op6_toxicity as op6
from . import op7_html_text as op7
from . import op8_substring_dedup as op8
from . import op9_fingerprints as op9
from . import op10_quality as op10
from . import op11_ranked_search as op11
from . import op12_periodic_runs as op12
from . import op13_differencing_packing as op13
from .common import table


def op1_packing(spark, sf_dir):
    """All documents, tokenised and packed into sequences of 4096 tokens."""
    return op1.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_topk_search(spark, sf_dir):
    """The ten largest integer inner products of every hundredth vector with all others."""
    vectors = op2.quantised(table(spark, sf_dir, "embeddings"))
    return op2.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op3_token_counts(spark, sf_dir):
    """Token count of every whole document under the 32k piece vocabulary."""
    return op3.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_mixing(spark, sf_dir):
    """All documents mixed so that sources weigh as the square root of their rows."""
    docs = table(spark, sf_dir, "documents")
    mixed = op4.mixed(docs, op4.tempered_weights(docs))
    return mixed.select("doc_id", "source", "lang", "copy", "n_copies", F.md5("text").alias("text_md5"))


def op5_jaccard_join(spark, sf_dir):
    """Near-duplicate class and number of links of every document."""
    return op5.jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op6_toxicity(spark, sf_dir):
    """Toxicity score of every whole document."""
    return op6.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_html_text(spark, sf_dir):
    """Main text of every whole page."""
    return op7.extracted(table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark, sf_dir):
    """Every document without the 50-word windows that a document of smaller id has."""
    kept = op8.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_fingerprints(spark, sf_dir):
    """Fingerprints of every document and its edited text, and their likeness."""
    return op9.fingerprints(table(spark, sf_dir, "documents"))


def op10_quality(spark, sf_dir):
    """Quality score of every whole document."""
    return op10.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ranked_search(spark, sf_dir):
    """The ten documents of highest score for every benchmark item."""
    return op11.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of every whole document, every tenth of them rewritten to a loop."""
    return op12.periodic_runs(table(spark, sf_dir, "documents"), rewrite=True)


def op13_differencing_packing(spark, sf_dir):
    """All documents, tokenised and packed into near-equal sequences of 2048 tokens."""
    return op13.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_topk_search": op2_topk_search,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_html_text": op7_html_text,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_quality": op10_quality,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_differencing_packing": op13_differencing_packing,
}

ORACLE_SQL = {
    "op2_topk_search": op2.SQL,
    "op4_mixing": op4.TEMPERED_SQL + """
SELECT doc_id, source, lang, CAST(unnest(range(1, n_copies + 1)) AS INTEGER) AS copy, CAST(n_copies AS INTEGER) AS n_copies,
       md5(text) AS text_md5 FROM m""",
    "op5_jaccard_join": op5.SQL,
    "op8_substring_dedup": op8.SQL,
    "op11_ranked_search": op11.SQL,
}
