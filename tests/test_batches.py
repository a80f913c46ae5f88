"""Statistics over results, on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from moodline.functions import report
from moodline.operators import batches

SCHEMA = (
    "client string, seq bigint, event_time timestamp, compound_score double, compound_sentiment string, "
    "processing_time double"
)


def results(spark, *counts):
    """``counts[i]`` results of client ``c<i>``; every third is positive, every third negative."""
    rows = (
        spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(counts)], "client string, n bigint")
        .filter("n > 0")
        .select("client", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("seq"))
    )
    turn = F.col("seq") % 3
    score = F.when(turn == 0, 0.5).when(turn == 1, -0.25).otherwise(0.0)
    label = F.when(turn == 0, "positive").when(turn == 1, "negative").otherwise("neutral")
    return rows.select(
        "client", "seq", F.timestamp_seconds(F.col("seq") * 2).alias("event_time"), score.alias("compound_score"),
        label.alias("compound_sentiment"), (F.col("seq") / 1000).alias("processing_time"),
    )


@pytest.mark.parametrize("n, sizes", [(0, []), (1, [1]), (9, [9]), (10, [10]), (11, [10, 1]), (25, [10, 10, 5])])
def test_batch_sizes(spark, n, sizes):
    summary = batches.batch_summary(results(spark, n)).orderBy("batch_id").collect()
    assert [r.batch_size for r in summary] == sizes
    assert [r.batch_id for r in summary] == list(range(1, len(sizes) + 1))
    full = batches.full_batches(results(spark, n))
    assert full.count() == 10 * (n // 10)
    assert batches.running_totals(results(spark, n)).count() == n // 10


def test_batch_summary_values(spark):
    first = batches.batch_summary(results(spark, 10)).first()
    # 3 positive (3, 6, 9), 4 negative (1, 4, 7, 10), 3 neutral
    assert (first.positive_count, first.negative_count, first.neutral_count) == (3, 4, 3)
    assert (first.positive_pct, first.negative_pct) == (30.0, 40.0)
    assert first.mean_compound == pytest.approx((1.5 - 1.0) / 10)
    assert first.mean_processing_ms == pytest.approx(5.5)
    assert first.duration_s == 18.0
    assert first.trend == "balanced"


@pytest.mark.parametrize("mean, trend", [(0.1, "balanced"), (0.1001, "positive"), (-0.1, "balanced"), (-0.1001, "negative")])
def test_trend_is_strict(spark, mean, trend):
    rows = spark.createDataFrame([("c", i, None, mean, "neutral", 0.0) for i in range(10)], SCHEMA)
    assert batches.batch_summary(rows).first().trend == trend
    assert batches.last_n_mean(rows).first().trend == trend


def test_clients_count_on_their_own(spark):
    summary = batches.batch_summary(results(spark, 12, 25).orderBy("seq"))
    assert {(r.client, r.batch_id): r.batch_size for r in summary.collect()} == {
        ("c0", 1): 10, ("c0", 2): 2, ("c1", 1): 10, ("c1", 2): 10, ("c1", 3): 5,
    }


@pytest.mark.parametrize("operator", [batches.batch_summary, batches.running_totals, batches.full_batches])
def test_a_hot_client_in_chunks_gives_the_same(spark, operator):
    rows = results(spark, 400, 35, 7, 35, 1)

    def values(df):
        return sorted(map(repr, df.select(sorted(df.columns)).collect()))

    assert values(operator(rows.repartition(7), chunk_rows=30)) == values(operator(rows))


def test_running_totals_and_recent_times(spark):
    ends = batches.running_totals(results(spark, 130)).orderBy("batch_id").collect()
    assert [r.total for r in ends] == list(range(10, 131, 10))
    last = ends[-1]
    assert (last.positive_count, last.negative_count, last.neutral_count) == (43, 44, 43)
    # mean of 31 … 130 ms
    assert last.recent_mean_processing_ms == pytest.approx(80.5)
    assert ends[2].recent_mean_processing_ms == pytest.approx(15.5)


def test_totals_and_no_results(spark):
    total = batches.sentiment_totals(results(spark, 9)).first()
    assert (total.total, total.positive_count, total.negative_count, total.neutral_count) == (9, 3, 3, 3)
    assert total.positive_pct == pytest.approx(100 / 3)
    assert batches.sentiment_totals(results(spark, 0)).count() == 0


@pytest.mark.parametrize("n, rows", [(0, 0), (1, 0), (2, 1), (49, 1), (50, 1), (51, 1)])
def test_final_sentiment_needs_two_and_takes_fifty(spark, n, rows):
    got = batches.last_n_mean(results(spark, n)).collect()
    assert len(got) == rows
    if rows:
        kept = range(max(1, n - 49), n + 1)
        values = [0.5 if i % 3 == 0 else -0.25 if i % 3 == 1 else 0.0 for i in kept]
        assert got[0].results == len(values)
        assert got[0].mean_compound == pytest.approx(sum(values) / len(values))


@pytest.mark.parametrize("n, labels", [(4, None), (5, "negative → neutral → positive → negative → neutral")])
def test_recent_trend_needs_five(spark, n, labels):
    got = batches.recent_trend(results(spark, n)).collect()
    assert [r.labels for r in got] == ([labels] if labels else [])
    by_client = batches.recent_trend(results(spark, n, 7), keys=["client"])
    assert {r.client for r in by_client.collect()} == ({"c0", "c1"} if labels else {"c1"})


@pytest.mark.parametrize("n, mean, least", [(1, 1.0, 1.0), (100, 50.5, 1.0), (101, 51.5, 2.0)])
def test_processing_stats_take_a_hundred(spark, n, mean, least):
    got = batches.processing_stats(results(spark, n)).first()
    assert (got.mean_ms, got.min_ms, got.max_ms) == (pytest.approx(mean), pytest.approx(least), pytest.approx(float(n)))


def test_latest_per_client_is_cut_before_the_shuffle(spark):
    plan = batches.last_n_mean(results(spark, 30, 30), keys=["client"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_report_functions(spark):
    row = spark.range(1).select(
        report.symbol(F.lit("positive")).alias("known"),
        report.symbol(F.lit("other")).alias("unknown"),
        report.signed(F.lit(0.5)).alias("up"),
        report.signed(F.lit(-0.0441)).alias("down"),
        report.percent_text(F.lit(1), F.lit(8)).alias("part"),
        report.percent(F.lit(1), F.lit(0)).alias("nothing"),
        report.millis_text(F.lit(0.00234)).alias("ms"),
        report.thousands(F.lit(1234567)).alias("many"),
        report.progress_bar(F.lit(3)).alias("bar"),
        report.clock(F.lit("2025-06-05 06:07:08").cast("timestamp")).alias("clock"),
        report.iso_text(F.lit("2025-06-05 06:07:08.5").cast("timestamp")).alias("iso"),
        report.file_stamp(F.lit("2025-06-05 06:07:08").cast("timestamp")).alias("stamp"),
    ).first()
    assert row.asDict() == {
        "known": "😊", "unknown": "🤔", "up": "+0.500", "down": "-0.044", "part": "12.5%", "nothing": None,
        "ms": "2.3ms", "many": "1,234,567", "bar": "███░░░░░░░", "clock": "06:07:08",
        "iso": "2025-06-05T06:07:08.500000", "stamp": "20250605_060708",
    }
