"""From raw documents to packed training sequences, in five stages.

Each stage reads all that the one before it kept, written as Parquet in the shared
folder, and all but the last give the columns of ``documents``. Near duplicates are
found on shingles of five words at a similarity of 0.8. Rows that the mix repeats are
repeated in its output, in training order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodline.llm import curriculum, line_chunks, ngram_join, packing, quality_rules
from moodline.llm.tables import staged, table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of quality rules keeps."""
    return quality_rules.accepted(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of chunks of lines go; every document stays, with what is left of its text."""
    return line_chunks.without_repeats(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return ngram_join.one_of_each(docs, k=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by their source's target, sorted by training position."""
    return curriculum.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids, sequences and places."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Hash orders and tokens are beyond SQL: tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
