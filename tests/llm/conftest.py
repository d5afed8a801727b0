import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """documents(texts) or documents([(doc_id, text), ...]): a table with the columns of documents."""

    def make(rows, **more):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", None if i is None else f"s{i % 3}", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls in any column, empty texts, ties, repeated rows, long texts and names that clash."""
    long = " ".join(f"word{i % 977} more{i % 13}." for i in range(30_000))
    rows = [(0, None), (1, ""), (2, "   \n\t "), (None, "a null key has a text of its own here"), (4, "same words again and again " * 30), (5, "same words again and again " * 30), (5, "same words again and again " * 30), (7, long), (8, "é" * 300 + "   ü\x00x"), (9, "one")]
    frame = documents(rows)
    from pyspark.sql import functions as F

    for name in ("fp", "shard", "slot", "count", "h", "n", "k", "word", "kind", "failure_bits", "copy_no", "u", "v"):
        frame = frame.withColumn(name, F.lit(1))
    return frame
