"""Live sessions, rates, batches and arrival order: the rows of the batch forms, in any number of micro-batches."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moodline.operators import batches, delivery
from moodline.schemas import CONNECTED, DISCONNECTED, ERROR, SENT
from moodline.streaming import epochs, live_batches, live_log

START = datetime(2025, 1, 1)
LOG = "seq bigint, event_time timestamp, client string, action string"
RESULT = live_batches._RESULT


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def events(n, seed=0):
    """A log in which one client has a third of the events, with ties, bursts and repeated connects."""
    pick, at, out = random.Random(seed), 0, []
    for i in range(n):
        at += pick.choice([0, 0, 1, 5, 40])
        client = "hot:1" if pick.random() < 0.33 else pick.choice(["a:1", "b:1", "c:2", None])
        action = pick.choices([CONNECTED, DISCONNECTED, SENT, ERROR, None], [2, 2, 8, 1, 1])[0]
        out.append((i, START + timedelta(seconds=at), client, action))
    return out


def arrive(spark, tmp_path, values, schema, parts, step, name="live"):
    """Each part of the rows is one micro-batch; the query starts anew for each."""
    size = max(1, -(-len(values) // parts))
    for p in range(parts):
        part = spark.createDataFrame(values[p * size : (p + 1) * size][::-1], schema)
        part.write.mode("append").parquet(str(tmp_path / f"{name}-in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / f"{name}-in"))
        epochs.start_epochs(stream, step, str(tmp_path / name), str(tmp_path / f"{name}-cp")).awaitTermination()
    return str(tmp_path / name)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_live_log_equals_batch(spark, tmp_path, parts):
    values = events(240)
    log = spark.createDataFrame(values, LOG).cache()
    messages = spark.range(11)
    # chunks of twenty events split the busy client
    step = epochs.combined(
        live_log.session_step(chunk_rows=20), live_log.trailing_rate_step(chunk_rows=20), live_log.history_step(), live_log.snapshot_step(messages)
    )
    out = arrive(spark, tmp_path, values, LOG, parts, step)
    assert epochs.finished_epochs(spark, out) == list(range(parts))
    assert rows(live_log.finished_sessions(spark, out)) == rows(delivery.session_durations(log))
    assert rows(live_log.client_stats(spark, out)) == rows(delivery.client_stats(log))
    assert rows(live_log.trailing_rates(spark, out)) == rows(delivery.trailing_rate(log))
    assert rows(live_log.connection_history(spark, out)) == rows(delivery.shown_history(log))
    assert rows(live_log.status_snapshot(spark, out)) == rows(delivery.status_snapshot(log, messages))
    if parts > 1:
        # each trigger has its own row: here the one after the first
        size = -(-len(values) // parts)
        early = spark.createDataFrame(values[:size], LOG)
        got = epochs.read_finished(spark, out, "snapshot").filter("epoch = 0").drop("epoch", "at")
        assert rows(got) == rows(delivery.status_snapshot(early, messages))


def test_the_history_shows_the_oldest_first(spark):
    values = [(i, START + timedelta(seconds=i), f"10.0.0.{i}:9", CONNECTED if i % 2 else DISCONNECTED) for i in range(6)]
    shown = delivery.shown_history(spark.createDataFrame(values, LOG)).orderBy("place").collect()
    assert [tuple(r) for r in shown] == [(1, "00:00:03", "10.0.0.3", "connect"), (2, "00:00:04", "10.0.0.4", "disconnect"), (3, "00:00:05", "10.0.0.5", "connect")]


def test_sends_that_come_late(spark, tmp_path):
    """Within the lateness they are rated exactly; behind the watermark they are late, and count for later sends."""
    at = lambda s: START + timedelta(seconds=s)
    values = [(0, at(0), "a", SENT), (1, at(50), "a", SENT), (2, at(30), "a", SENT), (3, at(100), "a", SENT), (4, at(70), "a", SENT), (5, at(120), "a", SENT)]
    out = arrive(spark, tmp_path, values, LOG, 6, live_log.trailing_rate_step(lateness_s=25))
    got = {r.seq: r.sends for r in live_log.trailing_rates(spark, out).collect()}
    late = [r.seq for r in epochs.read_finished(spark, out, "late_sends").collect()]
    assert late == [4] and got == {0: 1, 2: 2, 1: 3, 3: 4 - 1, 5: 3}


# -- epochs -------------------------------------------------------------------------------


def test_readers_see_finished_epochs_only(spark, tmp_path):
    """The third micro-batch stops between its files: readers see two epochs, and its second run completes it."""
    values = events(90, 1)
    whole = live_log.session_step()
    out = arrive(spark, tmp_path, values[:60], LOG, 2, whole)
    before = rows(live_log.finished_sessions(spark, out))

    def broken(batch, carried, keep):
        results, after = whole.run(batch, carried, keep)
        results["sessions_finished"].limit(1).withColumn("epoch", F.lit(2).cast("bigint")).write.parquet(f"{out}/sessions_finished/epoch-2")
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        arrive(spark, tmp_path, values[60:], LOG, 1, epochs.Step(whole.carried, broken))
    assert os.path.isdir(f"{out}/sessions_finished/epoch-2") and epochs.finished_epochs(spark, out) == [0, 1]
    assert rows(live_log.finished_sessions(spark, out)) == before
    arrive(spark, tmp_path, [], LOG, 1, whole)
    assert epochs.finished_epochs(spark, out)[:3] == [0, 1, 2]
    assert rows(live_log.finished_sessions(spark, out)) == rows(delivery.session_durations(spark.createDataFrame(values, LOG)))


def test_a_finished_epoch_that_runs_again_changes_nothing(spark, tmp_path):
    """The commit of the last micro-batch is lost after all of its files are written."""
    values = events(80, 2)
    out = arrive(spark, tmp_path, values, LOG, 2, live_log.session_step())
    before = rows(live_log.finished_sessions(spark, out)), rows(live_log.client_stats(spark, out))
    for name in ("1", ".1.crc"):
        if (tmp_path / "live-cp" / "commits" / name).exists():
            os.remove(tmp_path / "live-cp" / "commits" / name)
    stream = spark.readStream.schema(LOG).parquet(str(tmp_path / "live-in"))
    epochs.start_epochs(stream, live_log.session_step(), out, str(tmp_path / "live-cp")).awaitTermination()
    assert (rows(live_log.finished_sessions(spark, out)), rows(live_log.client_stats(spark, out))) == before
    with pytest.raises(FileExistsError):
        epochs.start_epochs(stream, live_log.session_step(), out, str(tmp_path / "another"))


def test_compacted_epochs(spark, tmp_path):
    values = events(120, 3)
    out = arrive(spark, tmp_path, values[:80], LOG, 3, live_log.session_step())
    before = rows(epochs.read_finished(spark, out, "sessions_finished"))
    assert epochs.compact(spark, out) == 2 and rows(epochs.read_finished(spark, out, "sessions_finished")) == before
    epochs.remove_compacted(spark, out)
    assert os.listdir(f"{out}/sessions_finished") == ["through-2"]
    assert rows(epochs.read_finished(spark, out, "sessions_finished")) == before
    arrive(spark, tmp_path, values[80:], LOG, 1, live_log.session_step())
    assert epochs.finished_epochs(spark, out) == [0, 1, 2, 3] and epochs.compact(spark, out) == 3
    epochs.remove_compacted(spark, out)
    assert os.listdir(f"{out}/sessions_finished") == ["through-3"]
    assert rows(live_log.finished_sessions(spark, out)) == rows(delivery.session_durations(spark.createDataFrame(values, LOG)))


# -- batches ------------------------------------------------------------------------------


def results(n, seed=0):
    """Results in order, numbered from 1 in every client; one client has more than a third."""
    pick, numbers, out = random.Random(seed), {}, []
    for i in range(n):
        client = "hot" if pick.random() < 0.4 else f"c{pick.randrange(4)}"
        numbers[client] = numbers.get(client, 0) + 1
        score = pick.randrange(-10_000, 10_001) / 10_000
        label = pick.choice(["positive", "negative", "neutral", "odd", None])
        out.append((client, numbers[client], score, label, pick.choice([None, pick.randrange(1, 900) / 1e6]), pick.choice([None, START + timedelta(seconds=i)])))
    return out


SUMMARY = ["client", "batch_id", "batch_size", "positive_count", "negative_count", "neutral_count", "positive_pct", "mean_compound", "mean_processing_ms", "duration_s", "trend"]


def check_batches(spark, out, values):
    stored = spark.createDataFrame(values, RESULT).cache()
    got = epochs.read_finished(spark, out, "batches").cache()
    assert rows(got.select(SUMMARY)) == rows(batches.batch_summary(stored).filter("batch_size = 10").select(SUMMARY))
    totals = {f"{x}_total": f"{x}_count" for x in ("positive", "negative", "neutral")}
    columns = ["client", "batch_id", "total", *totals.values(), "recent_mean_processing_ms"]
    running = got.drop(*totals.values()).withColumnsRenamed(totals)
    assert rows(running.select(columns)) == rows(batches.running_totals(stored).select(columns))
    for row in got.filter("client = 'hot' AND batch_id IN (1, 4, 9)").collect():
        upto = batches.assign_batches(stored.filter(F.col("client") == row.client)).filter(F.col("arrival") <= row.total)
        assert row.recent_mean_compound == batches.last_n_mean(upto, order=["seq"]).first().mean_compound
    return got


@pytest.mark.parametrize("parts", [1, 5])
def test_batches_across_micro_batches(spark, tmp_path, parts):
    values = results(420)
    out = arrive(spark, tmp_path, values, RESULT, parts, live_batches.batch_step(chunk_rows=25))
    check_batches(spark, out, values)
    count = {}
    for r in values:
        count[r[0]] = count.get(r[0], 0) + 1
    waiting = {r["client"]: r["count"] for r in live_batches.open_results(spark, out).groupBy("client").count().collect()}
    assert waiting == {c: n % 10 for c, n in count.items() if n % 10}


def test_no_task_holds_the_rows_of_a_client(spark):
    """The step runs no Python over rows, and gathers at most the labels of one batch."""
    kept = []

    def keep(df, name):
        kept.append(df._jdf.queryExecution().executedPlan().toString())
        return df.cache()

    step = live_batches.batch_step()
    frame = spark.createDataFrame(results(50), RESULT)
    none = {name: spark.createDataFrame([], ddl) for name, ddl in step.carried.items()}
    out, carried = step.run(frame, none, keep)
    plans = kept + [df._jdf.queryExecution().executedPlan().toString() for df in [*out.values(), *carried.values()]]
    assert not any("Pandas" in p or "PythonUDF" in p or "Cartesian" in p for p in plans)


@pytest.mark.parametrize("parts", [1, 5])
def test_results_in_any_order(spark, tmp_path, parts):
    values = results(300, 4)
    mixed = values[:]
    random.Random(1).shuffle(mixed)
    step = live_batches.in_order(live_batches.batch_step(), patience=parts + 1, chunk_rows=25)
    out = arrive(spark, tmp_path, mixed, RESULT, parts, step)
    check_batches(spark, out, values)
    assert epochs.read_finished(spark, out, "late_results").count() == 0
    assert epochs.read_carried(spark, out, "early").count() == 0


def test_gaps_repeats_and_late_results(spark, tmp_path):
    result = lambda seq, client="a": (client, seq, 0.1, "positive", 0.001, START)
    turns = [
        [result(1), result(2), result(4), result(4), result(None), result(7, None)],  # 3 is missing, 4 twice
        [result(5), result(1)],  # 1 has passed
        [result(6), result(8)],  # 4 has waited for two epochs: 3 is given up
        [result(3), result(7)],  # too late, and in time
    ]
    seen = []

    def note(batch, before, keep):
        seen.append(sorted(r.seq for r in batch.select("seq").collect()))
        return {}, {}

    step = live_batches.in_order(epochs.Step({}, note), patience=2)
    for k, turn in enumerate(turns):
        out = arrive(spark, tmp_path, turn, RESULT, 1, step)
    assert seen == [[1, 2], [], [4, 5, 6], [7, 8]]
    late = epochs.read_finished(spark, out, "late_results").select("epoch", "client", "seq").collect()
    assert sorted(map(repr, map(tuple, late))) == sorted(map(repr, [(0, "a", 4), (0, "a", None), (0, None, 7), (1, "a", 1), (3, "a", 3)]))
