"""The report of every full batch: its summary, the totals so far, and recent means and labels at its end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.labels import NEGATIVE, NEUTRAL, POSITIVE, trend_label
from moodline.functions.report import ARROW, seconds_between, symbol
from moodline.operators.batches import (
    BATCH_SIZE,
    SCORE_HISTORY,
    TIME_HISTORY,
    TREND_LENGTH,
    is_label,
    is_other,
    label_counts,
    mean_millis,
    mean_score,
    percentages,
    score_steps,
    time_micros,
)
from moodline.operators.ordered import CHUNK_ROWS, running_values, stored

RESULT_COLUMNS = ["client", "seq", "compound_score", "compound_sentiment", "processing_time", "event_time"]
SUMS = ["positive", "negative", "neutral", "steps", "micros", "timed"]


def report_steps() -> dict[str, Column]:
    """What ``running_values`` sums up for the functions below."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    flag = lambda condition: F.when(condition, one).otherwise(none)
    return {
        "arrival": one,
        "positive": flag(is_label(POSITIVE)),
        "negative": flag(is_label(NEGATIVE)),
        "neutral": flag(is_other()),
        "steps": F.coalesce(score_steps(), none),
        "micros": F.coalesce(time_micros(), none),
        "timed": flag(F.col("processing_time").isNotNull()),
    }


def completed_batches(numbered: DataFrame) -> DataFrame:
    """Full batches of numbered rows: their summary, running sums at their end, and last labels."""
    place = (F.col("arrival") - 1) % BATCH_SIZE + 1
    local = F.call_function("div", F.col("arrival") - 1, F.lit(BATCH_SIZE).cast("bigint")) + 1
    label = F.when(is_label(POSITIVE), POSITIVE).when(is_label(NEGATIVE), NEGATIVE).otherwise(NEUTRAL)
    last = F.when(place > BATCH_SIZE - TREND_LENGTH, F.struct(place.alias("place"), symbol(label).alias("symbol")))
    grouped = numbered.groupBy("client", local.alias("local")).agg(
        F.count(F.lit(1)).alias("batch_size"),
        *label_counts(),
        F.sum(score_steps()).alias("_steps"),
        F.sum(time_micros()).alias("_micros"),
        F.count("processing_time").alias("_timed"),
        seconds_between(F.min("event_time"), F.max("event_time")).alias("duration_s"),
        F.array_sort(F.collect_list(last)).alias("_last"),
        *[F.max(name).alias(name) for name in ("positive", "negative", "neutral", "timed")],
        # these may fall from row to row
        *[F.max_by(name, F.col("arrival")).alias(name) for name in ("steps", "micros")],
    )
    return grouped.filter(F.col("batch_size") == BATCH_SIZE)


def reported(done: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows of completed batches with their recent means: sums at their end less those at an earlier end."""
    marks = F.array(
        F.struct(F.lit(0).alias("shift"), F.lit(0).alias("kind")),
        F.struct(F.lit(SCORE_HISTORY).alias("shift"), F.lit(1).alias("kind")),
        F.struct(F.lit(TIME_HISTORY).alias("shift"), F.lit(2).alias("kind")),
    )
    at = lambda kind, name: F.coalesce(F.max(F.when(F.col("m.kind") == kind, F.col(name))), F.lit(0))
    merged = (
        ends.withColumn("m", F.explode(marks))
        .groupBy("client", (F.col("at") + F.col("m.shift")).alias("at"))
        .agg(
            (at(0, "steps") - at(1, "steps")).alias("recent_steps"),
            (at(0, "micros") - at(2, "micros")).alias("recent_micros"),
            (at(0, "timed") - at(2, "timed")).alias("recent_timed"),
        )
    )
    rows = done.join(merged, ["client", "at"])
    mean = mean_score(F.col("_steps"), F.col("batch_size"))
    recent = mean_score(F.col("recent_steps"), F.least(F.col("at"), F.lit(SCORE_HISTORY)))
    return rows.select(
        "client",
        F.call_function("div", F.col("at"), F.lit(BATCH_SIZE).cast("bigint")).alias("batch_id"),
        "batch_size",
        "positive_count",
        "negative_count",
        "neutral_count",
        *percentages("batch_size"),
        mean.alias("mean_compound"),
        mean_millis(F.col("_micros"), F.col("_timed")).alias("mean_processing_ms"),
        "duration_s",
        trend_label(mean).alias("trend"),
        F.col("at").alias("total"),
        *[F.col(name).alias(f"{name}_total") for name in ("positive", "negative", "neutral")],
        mean_millis(F.col("recent_micros"), F.col("recent_timed")).alias("recent_mean_processing_ms"),
        recent.alias("recent_mean_compound"),
        F.array_join(F.transform("_last", lambda r: r["symbol"]), ARROW).alias("recent_symbols"),
    )


def batch_reports(results: DataFrame, chunk_rows: int = CHUNK_ROWS, store: bool = True) -> DataFrame:
    """A row per full batch of every client: what a client of the stream shows after each ten results."""
    narrow = results.select(*RESULT_COLUMNS)
    numbered = running_values(stored(narrow, "results") if store else narrow, ["client"], ["seq"], report_steps(), chunk_rows=chunk_rows)
    done = completed_batches(numbered).withColumn("at", F.col("local") * BATCH_SIZE)
    done = stored(done, "completed") if store else done
    return reported(done, done.select("client", "at", *SUMS))
