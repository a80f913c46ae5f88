"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.llm import (
    block_names,
    cotraining,
    curriculum,
    line_chunks,
    ngram_join,
    nn_descent,
    packing,
    periodic_runs,
    quality_rules,
    site_style,
    toxicity,
    trie_frontier,
    warc,
)
from moodline.llm.tables import table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"), k=3, percent=90)


def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"), "doc_id")
    return quality_rules.apply_policy(rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op5_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extracted(table(spark, sf_dir, "pages"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.search(table(spark, sf_dir, "embeddings"))


def op7_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curriculum.plan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_removed", "text")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op11_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.groups(table(spark, sf_dir, "documents")).drop("row")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_frontier.variants(table(spark, sf_dir, "documents"), slips=199)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_cotraining": op2_cotraining,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_site_style": op5_site_style,
    "op6_nn_descent": op6_nn_descent,
    "op7_curriculum": op7_curriculum,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_block_naming": op11_block_naming,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}
