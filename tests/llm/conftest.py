from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Make a documents table of (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(*r, *(None,) * (5 - len(r))) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path
