"""From documents to packed training sequences, in five stages.

Each stage takes what the one before it kept, as read back from Parquet, and all
but the last return rows with the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from tessera.llm.common import durable, table
from tessera.llm.queries import byte_bpe


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that a classifier trained on these documents and ``labels`` doesn't call toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, up to white space, the row of least id."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 75 % of five-word shingles, the document of least id."""
    return jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's target asks for."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their place in sequences of 2048 ids."""
    return packing.pack(docs, byte_bpe())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classification, sketch joins and tokenisation are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
