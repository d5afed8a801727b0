"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept and returns
a DataFrame. All but the last return the columns of documents. run() writes each stage's result as
Parquet in the shared folder and reads it again for the next one, so a lost executor costs tasks of
one stage only.

Near-duplicates are texts alike in 0.8 of their five-word shingles or more, found by covering fingerprints
of their words and compared exactly; the four bits of 4-word shingles bind only the operator's own query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landtide.llm import mixing, packing, pii, quality, simhash
from landtide.llm.shared import stash, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
POLICY = 2


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that policy 2 of the rule ledger keeps."""
    return _documents(quality.ledger(docs).filter(quality.verdict(POLICY)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id."""
    return _documents(simhash.keep_one(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with general words in the place of personal data; n_chars follows the text."""
    return _documents(pii.sanitise(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the sources' target weights, in random order; a copy keeps its doc_id."""
    return _documents(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = _documents(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fingerprints and token ids can't be told in SQL.
ORACLE_SQL = None
