"""Streams give what the batch operators give, in any number of micro-batches, and after a restart."""

import json

import pytest
from pyspark.sql import functions as F

from moodline.operators import batches, delivery, lexicon, scoring
from moodline.schemas import CONNECTED, SENT
from moodline.sources import files
from moodline.streaming import feed, full_batches, monitor, progress

TEXTS = ["so good", "so bad", "nothing at all", "good, good!", "not good"]


@pytest.fixture(scope="module")
def words(spark):
    return lexicon.lexicon_from_rows(spark, [("good", 20, 700, 600), ("bad", -25, -700, 660)]).cache()


def packet(i):
    client = "hot:1" if i % 3 else f"c{i % 4}:1"
    return json.dumps(
        {"id": str(i), "text": TEXTS[i % len(TEXTS)], "client": client, "seq": i, "stream_id": 10_000 + i,
         "stream_timestamp": f"2025-01-01T00:{i // 60:02d}:{i % 60:02d}"}
    )


def lines(n):
    out = [packet(i) for i in range(n)]
    out.insert(5, "{bad")
    out.insert(9, '{"type":"welcome","message":"hi"}')
    out.insert(12, "")
    return out


def drop_files(folder, values, parts, first=0):
    """One file per part, in order, with rising times."""
    import os

    folder.mkdir(exist_ok=True)
    size = -(-len(values) // parts)
    for p in range(parts):
        path = folder / f"part-{first + p:03d}.txt"
        # rows of a file are turned round: arrival order comes from ``seq``
        path.write_text("".join(v + "\n" for v in reversed(values[p * size : (p + 1) * size])))
        os.utime(path, (1_700_000_000 + first + p,) * 2)


def score(df, words):
    out = feed.score_lines(
        df, words, scoring.EMPHASIS, processed_at=F.lit("T"), processing_time=(F.col("seq") + 1) / 1000
    )
    return out.withColumn("event_time", F.to_timestamp("timestamp"))


def run(df, out, checkpoint):
    feed.write_by_epoch(df, str(out), str(checkpoint)).awaitTermination(120)


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_stream_equals_batch(spark, words, tmp_path, parts):
    drop_files(tmp_path / "in", lines(97), parts)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    run(score(stream, words), tmp_path / "out", tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("epoch").distinct().count() == parts
    assert rows(got.drop("epoch")) == rows(score(files.read_packets(spark, str(tmp_path / "in")), words))
    assert got.count() == 97


def summary_columns(df):
    columns = ["client", "batch_id", "batch_size", "positive_count", "negative_count", "neutral_count", "positive_pct",
               "mean_compound", "mean_processing_ms", "duration_s", "trend"]
    return rows(df.select(*columns))


@pytest.mark.parametrize("parts", [1, 5])
def test_batches_and_histories_across_micro_batches(spark, words, tmp_path, parts):
    drop_files(tmp_path / "in", lines(260), parts)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    run(progress.batch_progress(score(stream, words), idle_minutes=None), tmp_path / "out", tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    stored = score(files.read_packets(spark, str(tmp_path / "in")), words).cache()
    assert summary_columns(got) == summary_columns(batches.batch_summary(stored).filter("batch_size = 10"))

    ends = batches.running_totals(stored)
    renamed = got.withColumnsRenamed({f"{x}_count": f"{x}_old" for x in ("positive", "negative", "neutral")})
    renamed = renamed.withColumnsRenamed({f"{x}_total": f"{x}_count" for x in ("positive", "negative", "neutral")})
    columns = ["client", "batch_id", "total", "positive_count", "negative_count", "neutral_count",
               "recent_mean_processing_ms"]
    assert rows(renamed.select(*columns)) == rows(ends.select(*columns))

    # the last full batch of the busy client, against the rows up to it
    last = got.filter("client = 'hot:1'").orderBy(F.col("batch_id").desc()).first()
    numbered = batches.assign_batches(stored.filter("client = 'hot:1'")).filter(F.col("arrival") <= last.total)
    assert last.recent_mean_compound == batches.last_n_mean(numbered).first().mean_compound
    assert last.recent_symbols == batches.recent_trend(numbered).first().symbols


def test_restart_continues_without_doubles(spark, words, tmp_path):
    values = lines(120)
    drop_files(tmp_path / "in", values[:60], 2)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    run(progress.batch_progress(score(stream, words), idle_minutes=None), tmp_path / "out", tmp_path / "cp")
    drop_files(tmp_path / "in", values[60:], 2, first=2)
    again = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    run(progress.batch_progress(score(again, words), idle_minutes=None), tmp_path / "out", tmp_path / "cp")
    stored = score(files.read_packets(spark, str(tmp_path / "in")), words)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert summary_columns(got) == summary_columns(batches.batch_summary(stored).filter("batch_size = 10"))


def test_a_replayed_micro_batch_overwrites(spark, words, tmp_path):
    """The commit of the last micro-batch is lost, so it runs again."""
    drop_files(tmp_path / "in", lines(40), 2)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    run(score(stream, words), tmp_path / "out", tmp_path / "cp")
    for commit in (tmp_path / "cp" / "commits").glob("*1*"):
        commit.unlink()
    run(score(files.stream_packets(spark, str(tmp_path / "in"), max_files=1), words), tmp_path / "out", tmp_path / "cp")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40


def test_rejects_are_kept(spark, tmp_path):
    drop_files(tmp_path / "in", lines(20), 2)
    stream = files.stream_packets(spark, str(tmp_path / "in"))
    feed.start_rejects(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["{bad"]


def test_idle_client_is_summarised():
    """The state function itself, when the time of a silent client runs out."""
    import numpy as np

    class Idle:
        exists = hasTimedOut = True
        kept = np.array([[5000, 1, 2000, 10], [-2500, -1, 4000, 20], [0, 0, 6000, 40]], dtype=np.int64)
        get = (13, 5, 4, 4, kept.tobytes())
        removed = False

        def remove(self):
            self.removed = True

    state = Idle()
    (out,) = list(progress._advance(("c",), iter([]), state, 1000))
    row = out.iloc[0]
    assert (row.batch_id, row.batch_size, row.total, row.positive_total) == (2, 3, 13, 5)
    assert (row.positive_count, row.negative_count, row.steps, row.first_micros, row.last_micros) == (1, 1, 2500, 10, 40)
    assert state.removed


def test_live_counters(spark, tmp_path):
    rows_in = [(0.0, "c", CONNECTED), (1.0, "c", SENT), (5.0, "c", SENT), (61.0, "c", SENT), (64.5, "c", SENT)]
    log = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows_in)], "seq bigint, s double, client string, action string"
    ).select("seq", F.timestamp_micros((F.col("s") * 1e6).cast("bigint")).alias("event_time"), "client", "action")
    log.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    seen = {}

    def keep(name):
        return lambda batch, _: seen.update({name: [r.asDict() for r in batch.collect()]})

    monitor.start_monitor(monitor.live_status(stream), keep("status"), str(tmp_path / "a"), None).awaitTermination(60)
    monitor.start_monitor(
        monitor.sends_per_minute(stream), keep("rate"), str(tmp_path / "b"), None
    ).awaitTermination(60)
    assert (seen["status"][0]["total_sent"], seen["status"][0]["status"]) == (4, "STREAMING")
    rates = {r["at"].minute * 60 + r["at"].second: r["sends"] for r in seen["rate"]}
    # the step at 65 s no longer holds the send at 5 s
    assert rates[5] == 2 and rates[60] == 2 and rates[65] == 2 and rates[120] == 2
    at_sends = {r.seq: r.sends for r in delivery.trailing_rate(log).collect()}
    assert at_sends[2] == rates[5]


def test_missing_values_are_the_same_in_stream_and_batch(spark, words, tmp_path):
    def spoiled(i):
        fields = json.loads(packet(i))
        if i % 4 == 0:
            del fields["stream_timestamp"]
        if i % 35 == 3:
            fields["stream_timestamp"] = "never"
        return json.dumps(fields)

    def timed(df):
        out = feed.score_lines(df, words, processed_at=F.lit("T"), processing_time=F.when(F.col("seq") % 3 != 0, F.col("seq") / 1000))
        return out.withColumn("event_time", F.try_to_timestamp("timestamp"))

    drop_files(tmp_path / "in", [spoiled(i) for i in range(230)], 3)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    run(progress.batch_progress(timed(stream), idle_minutes=None), tmp_path / "out", tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    results = timed(files.read_packets(spark, str(tmp_path / "in"))).cache()
    assert summary_columns(got) == summary_columns(batches.batch_summary(results).filter("batch_size = 10"))
    ends = batches.running_totals(results).select("client", "batch_id", "recent_mean_processing_ms")
    assert rows(got.select(ends.columns)) == rows(ends)
    none = results.withColumn("processing_time", F.lit(None).cast("double")).withColumn("event_time", F.lit(None).cast("timestamp"))
    assert batches.batch_summary(none).filter("mean_processing_ms IS NOT NULL OR duration_s IS NOT NULL").count() == 0


def test_a_large_lexicon_scores_a_stream(spark, words, tmp_path, monkeypatch):
    drop_files(tmp_path / "in", lines(40), 2)
    want = rows(feed.score_lines(files.read_packets(spark, str(tmp_path / "in")), words, processed_at=F.lit("T")).drop("processing_time"))
    monkeypatch.setattr(lexicon, "MAX_INDEX_ROWS", 1)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    feed.start_scoring(stream, words, str(tmp_path / "out"), str(tmp_path / "cp"), processed_at=F.lit("T")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).drop("epoch")
    assert rows(got.drop("processing_time")) == want
    assert got.filter("processing_time > 0").count() == 40


@pytest.mark.parametrize("parts", [1, 4])
def test_rows_of_full_batches(spark, words, tmp_path, parts):
    drop_files(tmp_path / "in", lines(97), parts)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    full_batches.start_full_batches(score(stream, words), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(240)
    results = score(files.read_packets(spark, str(tmp_path / "in")), words).cache()
    assert rows(full_batches.read_full_batches(spark, str(tmp_path / "out"))) == rows(batches.full_batches(results).drop("arrival"))
    every = batches.summarise_batches(full_batches.read_all_batches(spark, str(tmp_path / "out")))
    assert rows(every) == rows(batches.batch_summary(results))


def test_a_silent_client_ends_through_the_stream(spark, words, tmp_path):
    import time

    drop_files(tmp_path / "in", lines(33), 1)
    stream = files.stream_packets(spark, str(tmp_path / "in"), max_files=1)
    query = feed.write_by_epoch(
        progress.batch_progress(score(stream, words), idle_minutes=0.05), str(tmp_path / "out"), str(tmp_path / "cp"), every="1 second"
    )
    want = summary_columns(batches.batch_summary(score(files.read_packets(spark, str(tmp_path / "in")), words)))
    try:
        until = time.monotonic() + 90
        got = None
        while got != want and time.monotonic() < until:
            time.sleep(1)
            if list((tmp_path / "out").glob("epoch=*/part-*")):
                got = summary_columns(spark.read.parquet(str(tmp_path / "out")))
    finally:
        query.stop()
    assert got == want


def test_late_sends_are_left_out(spark, tmp_path):
    import os

    def drop(i, seconds):
        log = spark.createDataFrame([(s, "c", SENT) for s in seconds], "s double, client string, action string").coalesce(1)
        log = log.select(F.timestamp_micros((F.col("s") * 1e6).cast("bigint")).alias("event_time"), "client", "action")
        log.write.mode("append").parquet(str(tmp_path / "log"))
        for part in (tmp_path / "log").glob("part-*"):
            if part.name not in seen:
                seen.add(part.name)
                os.utime(part, (1_700_000_000 + i,) * 2)
        return log.schema

    seen = set()
    for i, seconds in enumerate(([10.0, 400.0], [401.0], [20.0, 402.0])):
        schema = drop(i, seconds)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    feed.write_by_epoch(monitor.sends_per_minute(stream), str(tmp_path / "out"), str(tmp_path / "cp"), output_mode="append").awaitTermination(120)
    got = {r["at"].minute * 60 + r["at"].second: r["sends"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # The send at 10 s is in the windows that close; that at 20 s came after them.
    assert got[10] == got[65] == 1 and all(n == 1 for at, n in got.items() if at < 300)


def test_results_of_another_checkpoint_are_not_overwritten(spark, words, tmp_path):
    drop_files(tmp_path / "in", lines(10), 1)
    run(score(files.stream_packets(spark, str(tmp_path / "in")), words), tmp_path / "out", tmp_path / "cp")
    with pytest.raises(FileExistsError):
        run(score(files.stream_packets(spark, str(tmp_path / "in")), words), tmp_path / "out", tmp_path / "other")
