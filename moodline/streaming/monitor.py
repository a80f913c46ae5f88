"""Live counters over a delivery-log stream and a result stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodline.functions.labels import NEUTRAL
from moodline.operators.delivery import STREAMING, WAITING, is_action
from moodline.schemas import CONNECTED, DISCONNECTED, ERROR, SENT
from moodline.streaming.feed import trigger_of

STATUS_EVERY = "5 seconds"


def sends_per_minute(
    log: DataFrame, window: str = "60 seconds", step: str = "5 seconds", lateness: str = "1 minute"
) -> DataFrame:
    """Sends of the minute up to each step; events later than ``lateness`` are left out.

    A window of Spark holds its start and not its end. Here it is the other way round,
    so the time is moved back by one microsecond.
    """
    moved = F.timestamp_micros(F.unix_micros("event_time") - 1)
    sends = log.filter(is_action(SENT)).select(moved.alias("_moved")).withWatermark("_moved", lateness)
    return (
        sends.groupBy(F.window("_moved", window, step))
        .agg(F.count(F.lit(1)).alias("sends"))
        .select(F.col("window.end").alias("at"), "sends")
    )


def live_status(log: DataFrame) -> DataFrame:
    """Counters of the whole log so far, in one row (complete mode)."""
    step = F.when(is_action(CONNECTED), 1).when(is_action(DISCONNECTED), -1).otherwise(0).cast("bigint")
    return log.agg(
        F.count_if(is_action(SENT)).alias("total_sent"),
        F.count_if(is_action(CONNECTED)).alias("total_connections"),
        F.coalesce(F.sum(step), F.lit(0)).alias("active_connections"),
        F.count_if(is_action(ERROR)).alias("errors"),
        F.max("event_time").alias("last_activity"),
    ).withColumn("status", F.when(F.col("active_connections") > 0, STREAMING).otherwise(WAITING))


def live_label_counts(results: DataFrame) -> DataFrame:
    """Results by label so far (update or complete mode)."""
    label = F.coalesce("compound_sentiment", F.lit(NEUTRAL))
    return results.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("results"))


def start_monitor(
    counters: DataFrame,
    show: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = STATUS_EVERY,
    output_mode: str = "complete",
) -> StreamingQuery:
    """Hand the counters to ``show`` at every interval."""
    return (
        counters.writeStream.foreachBatch(show)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(every))
        .start()
    )
