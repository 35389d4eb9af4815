"""A training corpus from the documents table, stage by stage.

Every stage takes (spark, docs, sf_dir) and gives back a table; `run` writes it to the shared
folder and reads it again for the next stage. The first four keep the columns of documents. A
document is dropped only by its language (no language holds a part of its words), as a copy, as
a near copy (five-word shingles, similarity 0.8), or because the mix takes none of it.

SQL cannot express the stages (learned weights, minwise trees, tokens), so ORACLE_SQL is None
and the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plazalens.llm import exact_dedup, langid, mixing, near_dedup, packing
from plazalens.llm.common import kept, ship, table

ORACLE_SQL: str | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents without a word, or of no language, go."""
    ship(spark)
    return langid.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of equal texts the one with the smallest id stays."""
    ship(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near copies the one with the smallest id stays."""
    ship(spark)
    return near_dedup.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents as often as the mix of the sources takes them. The document at a
    source's threshold comes whole or not at all."""
    ship(spark)
    return mixing.apply_mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the pieces of all documents and their places in sequences of 2048 ids."""
    ship(spark)
    return packing.pieces(packing.pack(docs))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing sources to target weights", source_mix),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table: one row per packed piece."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
