"""The library in Spark SQL: label functions, and results and logs as views of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodline.functions import labels
from moodline.operators import batches, delivery
from moodline.operators.ordered import stored


def _three_way(name: str, above: str, below: str, limit: float, otherwise: str) -> str:
    cases = f"WHEN score {above} {limit}D THEN '{labels.POSITIVE}' WHEN score {below} -{limit}D THEN '{labels.NEGATIVE}'"
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(score DOUBLE) RETURNS STRING RETURN CASE {cases} ELSE '{otherwise}' END"


def register_functions(spark: SparkSession, compound: float = 0.05, other: float = 0.1) -> None:
    """``compound_label``, ``polarity_label`` and ``trend_label`` of a score, for this session; see ``functions/labels.py``."""
    spark.sql(_three_way("compound_label", ">=", "<=", compound, labels.NEUTRAL))
    spark.sql(_three_way("polarity_label", ">", "<", other, labels.NEUTRAL))
    spark.sql(_three_way("trend_label", ">", "<", other, labels.BALANCED))


def register_results(spark: SparkSession, results: DataFrame, prefix: str = "") -> None:
    """Views ``results`` (with ``arrival`` and ``batch_id``), ``batch_summary`` and ``sentiment_totals``.

    Results are numbered and stored once, so that no view scores a text again.
    """
    numbered = stored(batches.assign_batches(results), "numbered")
    numbered.createOrReplaceTempView(f"{prefix}results")
    batches.summarise_batches(numbered).createOrReplaceTempView(f"{prefix}batch_summary")
    batches.sentiment_totals(numbered).createOrReplaceTempView(f"{prefix}sentiment_totals")


def register_log(spark: SparkSession, log: DataFrame, prefix: str = "") -> None:
    """Views ``delivery_log`` (with ``session``, ``in_session``), ``sessions`` and ``client_stats``."""
    delivery.with_sessions(log).createOrReplaceTempView(f"{prefix}delivery_log")
    delivery.sessions(log).createOrReplaceTempView(f"{prefix}sessions")
    delivery.client_stats(log).createOrReplaceTempView(f"{prefix}client_stats")
