"""Statistics over results: totals, count-based batches, recent history, trends.

``results`` needs ``client``, ``seq`` (arrival order within a client), the integer-valued
``compound_score`` in steps of 0.0001, ``compound_sentiment``, and for the timing
columns ``processing_time`` in seconds and ``event_time``. Missing times are left out of
means, extremes and durations everywhere.

Ordered statistics look at their input more than once. So that texts are scored once,
the columns they need are stored first; ``store=False`` is for results that are stored
already. The latest results over all clients are those with the latest ``event_time``,
then by client and ``seq``, as ``seq`` counts within a client only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.functions.labels import NEGATIVE, POSITIVE, trend_label
from moodline.functions.report import ARROW, seconds_between, symbol
from moodline.operators.ordered import CHUNK_ROWS, running_values, stored

# Fixed values.
BATCH_SIZE = 10
SCORE_HISTORY = 50
TIME_HISTORY = 100
TREND_LENGTH = 5

_SCORE_STEPS = 10_000
_MICROS = 1_000_000


def score_steps(compound: Column | str = "compound_score") -> Column:
    """Compound score in whole steps, so that sums are exact in any order."""
    column = F.col(compound) if isinstance(compound, str) else compound
    return F.round(column * _SCORE_STEPS).cast("bigint")


def time_micros(seconds: Column | str = "processing_time") -> Column:
    """Seconds in whole microseconds, for the same reason."""
    column = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.round(column * _MICROS).cast("bigint")


def is_label(label: str) -> Column:
    return F.col("compound_sentiment") == label


def is_other() -> Column:
    """Everything that is neither positive nor negative counts as neutral."""
    return ~F.coalesce(is_label(POSITIVE) | is_label(NEGATIVE), F.lit(False))


def label_counts() -> list[Column]:
    """Counts by label, for ``agg``."""
    return [
        F.count_if(is_label(POSITIVE)).alias("positive_count"),
        F.count_if(is_label(NEGATIVE)).alias("negative_count"),
        F.count_if(is_other()).alias("neutral_count"),
    ]


def percentages(total: str) -> list[Column]:
    """Percentages of the three counts, unrounded."""
    return [
        (F.col(f"{label}_count") / F.nullif(F.col(total), F.lit(0)) * 100).alias(f"{label}_pct")
        for label in ("positive", "negative", "neutral")
    ]


def mean_score(steps: Column, count: Column) -> Column:
    return steps / F.nullif(count, F.lit(0)) / F.lit(float(_SCORE_STEPS))


def mean_millis(micros: Column, count: Column) -> Column:
    return micros / F.nullif(count, F.lit(0)) / F.lit(1000.0)


def sentiment_totals(results: DataFrame) -> DataFrame:
    """Counts and percentages by label in one row; no row without results."""
    totals = results.agg(F.count(F.lit(1)).alias("total"), *label_counts())
    return totals.filter(F.col("total") > 0).select("*", *percentages("total"))


def assign_batches(
    results: DataFrame,
    keys: Sequence[str] = ("client",),
    order: Sequence[str] = ("seq",),
    size: int = BATCH_SIZE,
    chunk_rows: int = CHUNK_ROWS,
    store: bool = True,
) -> DataFrame:
    """Number the results of each client by arrival and put every ``size`` of them in a batch."""
    numbered = running_values(
        stored(results, "results") if store else results, list(keys), list(order), {"arrival": F.lit(1).cast("bigint")}, chunk_rows=chunk_rows
    )
    return numbered.withColumn("batch_id", _batch_of(F.col("arrival"), size))


def _batch_of(arrival: Column, size: int) -> Column:
    return F.call_function("div", arrival - 1, F.lit(size).cast("bigint")) + 1


def summarise_batches(batched: DataFrame, keys: Sequence[str] = ("client",)) -> DataFrame:
    """One row per batch of rows that have a ``batch_id``, the short last batch included."""
    sums = batched.groupBy(*keys, "batch_id").agg(
        F.count(F.lit(1)).alias("batch_size"),
        *label_counts(),
        F.sum(score_steps()).alias("_steps"),
        F.sum(time_micros()).alias("_micros"),
        F.count("processing_time").alias("_timed"),
        seconds_between(F.min("event_time"), F.max("event_time")).alias("duration_s"),
    )
    size = F.col("batch_size")
    mean = mean_score(F.col("_steps"), size)
    return sums.select(
        *keys,
        "batch_id",
        "batch_size",
        "positive_count",
        "negative_count",
        "neutral_count",
        *percentages("batch_size"),
        mean.alias("mean_compound"),
        mean_millis(F.col("_micros"), F.col("_timed")).alias("mean_processing_ms"),
        "duration_s",
        trend_label(mean).alias("trend"),
    )


def batch_summary(
    results: DataFrame,
    keys: Sequence[str] = ("client",),
    order: Sequence[str] = ("seq",),
    size: int = BATCH_SIZE,
    chunk_rows: int = CHUNK_ROWS,
    store: bool = True,
) -> DataFrame:
    """Summary of every batch of every client."""
    narrow = results.select(*keys, *order, "compound_score", "compound_sentiment", "processing_time", "event_time")
    return summarise_batches(assign_batches(narrow, keys, order, size, chunk_rows, store), keys)


def full_batches(
    results: DataFrame,
    keys: Sequence[str] = ("client",),
    order: Sequence[str] = ("seq",),
    size: int = BATCH_SIZE,
    chunk_rows: int = CHUNK_ROWS,
    store: bool = True,
) -> DataFrame:
    """The results that belong to complete batches."""
    batched = assign_batches(results, keys, order, size, chunk_rows, store)
    # a window over one batch holds ``size`` rows at most
    in_batch = F.count(F.lit(1)).over(Window.partitionBy(*keys, "batch_id"))
    return batched.withColumn("_in_batch", in_batch).filter(F.col("_in_batch") == size).drop("_in_batch")


def running_totals(
    results: DataFrame,
    keys: Sequence[str] = ("client",),
    order: Sequence[str] = ("seq",),
    size: int = BATCH_SIZE,
    history: int = TIME_HISTORY,
    chunk_rows: int = CHUNK_ROWS,
    store: bool = True,
) -> DataFrame:
    """Overall counts, percentages and recent mean time at the end of every full batch.

    The mean time is over the last ``history`` results, a multiple of the batch size:
    the running sum at the batch less the one ``history`` results earlier, which is
    another row of the same table.
    """
    if history % size:
        raise ValueError("history must be a multiple of the batch size")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    narrow = results.select(*keys, *order, "compound_sentiment", "processing_time")
    numbered = running_values(
        stored(narrow, "results") if store else narrow,
        list(keys),
        list(order),
        {
            "total": one,
            "positive_count": F.when(is_label(POSITIVE), one).otherwise(none),
            "negative_count": F.when(is_label(NEGATIVE), one).otherwise(none),
            "neutral_count": F.when(is_other(), one).otherwise(none),
            "_micros": F.coalesce(time_micros(), none),
            "_timed": F.when(F.col("processing_time").isNotNull(), one).otherwise(none),
        },
        chunk_rows=chunk_rows,
    )
    ends = numbered.filter(F.col("total") % size == 0).select(
        *keys,
        _batch_of(F.col("total"), size).alias("batch_id"),
        "total",
        "positive_count",
        "negative_count",
        "neutral_count",
        "_micros",
        "_timed",
    )
    # each end gives its sums to itself and takes it from the end ``history`` later
    marks = F.array(
        F.struct(
            F.col("batch_id").alias("at"), F.col("_micros").alias("micros"), F.col("_timed").alias("timed"), F.lit(True).alias("own")
        ),
        F.struct(
            (F.col("batch_id") + history // size).alias("at"),
            (-F.col("_micros")).alias("micros"),
            (-F.col("_timed")).alias("timed"),
            F.lit(False).alias("own"),
        ),
    )
    counted = ["total", "positive_count", "negative_count", "neutral_count"]
    merged = (
        ends.withColumn("_mark", F.explode(marks))
        .groupBy(*keys, F.col("_mark.at").alias("batch_id"))
        .agg(
            *[F.max(F.when(F.col("_mark.own"), F.col(name))).alias(name) for name in counted],
            F.sum("_mark.micros").alias("_micros"),
            F.sum("_mark.timed").alias("_timed"),
        )
        .filter(F.col("total").isNotNull())
    )
    return merged.select(
        *keys,
        "batch_id",
        *counted,
        *percentages("total"),
        mean_millis(F.col("_micros"), F.col("_timed")).alias("recent_mean_processing_ms"),
    )


def _latest_by(order: Sequence[str] | None, keys: Sequence[str]) -> list[str]:
    """The order given, or one that is total: ``seq`` within a client, time first over several."""
    return list(order or (("seq",) if keys else ("event_time", "client", "seq")))


def last_n(results: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The ``n`` latest results, of each key if there are keys.

    Every task keeps ``n`` rows per key before the shuffle, so a hot key stays small.
    """
    latest = [F.col(c).desc() for c in order]
    if not keys:
        return results.orderBy(*latest).limit(n)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest))
    return results.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def last_n_mean(
    results: DataFrame, n: int = SCORE_HISTORY, order: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Mean compound score and trend of the latest results; only where there are at least two."""
    order = _latest_by(order, keys)
    recent = last_n(results.select(*keys, *order, "compound_score"), n, order, keys)
    sums = recent.groupBy(*keys).agg(F.count(F.lit(1)).alias("results"), F.sum(score_steps()).alias("_steps"))
    mean = mean_score(F.col("_steps"), F.col("results"))
    return sums.filter(F.col("results") > 1).select(
        *keys, "results", mean.alias("mean_compound"), trend_label(mean).alias("trend")
    )


def recent_trend(
    results: DataFrame, k: int = TREND_LENGTH, order: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """The latest ``k`` labels from old to new, as text and as symbols; only where there are ``k``."""
    order = _latest_by(order, keys)
    recent = last_n(results.select(*keys, *order, "compound_sentiment"), k, order, keys)
    labels = recent.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*order, "compound_sentiment"))).alias("_rows")
    )
    return labels.filter(F.size("_rows") >= k).select(
        *keys,
        F.array_join(F.transform("_rows", lambda r: r["compound_sentiment"]), ARROW).alias("labels"),
        F.array_join(F.transform("_rows", lambda r: symbol(r["compound_sentiment"])), ARROW).alias("symbols"),
    )


def processing_stats(
    results: DataFrame, n: int = TIME_HISTORY, order: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Mean, least and greatest processing time in ms of the latest results; no row without any."""
    order = _latest_by(order, keys)
    recent = last_n(results.select(*keys, *order, "processing_time"), n, order, keys)
    sums = recent.groupBy(*keys).agg(
        F.count("processing_time").alias("results"),
        F.sum(time_micros()).alias("_micros"),
        F.min("processing_time").alias("_least"),
        F.max("processing_time").alias("_greatest"),
    )
    return sums.filter(F.col("results") > 0).select(
        *keys,
        "results",
        mean_millis(F.col("_micros"), F.col("results")).alias("mean_ms"),
        (F.col("_least") * 1000).alias("min_ms"),
        (F.col("_greatest") * 1000).alias("max_ms"),
    )
