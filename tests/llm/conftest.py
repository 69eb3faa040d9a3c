import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from [(doc_id, text)] or [(doc_id, text, source)]."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    from tabsmith.llm.common import table
    return table(spark, SMALL, "documents")


@pytest.fixture(autouse=True)
def shipped(spark):
    from tabsmith.llm.common import ship
    ship(spark)
