"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline import sql
from moodline.functions import report
from moodline.functions.labels import label_compound, label_polarity, trend_label
from moodline.functions.text import clip
from moodline.operators import batches, delivery, lexicon, messages, packets, reports, sampling, scoring
from moodline.operators.ordered import stored
from moodline.plans import adapters, flows
from moodline.schemas import METRICS
from moodline.session import new_shared_path
from moodline.sources import files
from moodline.streaming import epochs, feed, live_batches, live_log, monitor
from moodline.streaming import full_batches as full_batches_stream

Query = Callable[[SparkSession, str], DataFrame]

_ALL_FILES = 1_000_000
SAMPLE_SEED = 7
# Small enough that the tables are cut into several chunks.
SMALL_CHUNK = 50
CAP_OF_TEST = 2
RATE_WINDOW_OF_TEST_S = 3600
# Micro-batches of the registered live streams.
TURNS = 3
BATCH_TURNS = 2


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def _flat_metrics() -> list[Column]:
    return [F.col(f"public_metrics.{n}").alias(n) for n in METRICS.names]


# -- messages -----------------------------------------------------------------


def read_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "messages")
    files.write_messages(adapters.messages(spark, sf_dir), path)
    return files.read_messages(spark, path).select(
        "id", "text", "created_at", "author_id", "lang", *_flat_metrics(),
        F.get("context_annotations", F.lit(0))["entity"].alias("first_entity"),
    )


def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = messages.select_packet_columns(adapters.clean(spark, sf_dir))
    return kept.select("id", "text", "created_at", "author_id", *_flat_metrics())


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.preview(adapters.clean(spark, sf_dir), ["seq"])


# -- packets ------------------------------------------------------------------


def build_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.packets(spark, sf_dir).select(
        "id", "text", "original_created_at", "author_id", *_flat_metrics(), "stream_timestamp", "stream_id",
        "server_info.*", "client", "seq",
    )


def packet_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = packets.encode_packets(adapters.packets(spark, sf_dir))
    return encoded.select(
        F.get_json_object("value", "$.id").alias("id"),
        F.get_json_object("value", "$.text").alias("text"),
        F.get_json_object("value", "$.public_metrics.like_count").cast("bigint").alias("like_count"),
        F.size(F.json_object_keys(F.get_json_object("value", "$.public_metrics"))).cast("bigint").alias("metrics"),
        F.get_json_object("value", "$.server_info.client_ip").alias("client_ip"),
        F.get_json_object("value", "$.server_info.total_tweets_sent").cast("bigint").alias("total_tweets_sent"),
    )


def parse_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = packets.parse_packets(adapters.lines(spark, sf_dir))
    return parsed.select("doc_id", "is_control", "packet.id", "packet.text", "packet.stream_id")


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.rejected_lines(adapters.lines(spark, sf_dir)).select("doc_id")


def drop_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = packets.drop_control(packets.parse_packets(adapters.lines(spark, sf_dir)))
    return kept.select("doc_id", "id", "client", "seq", "server_info.server_port")


def control_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.control_messages(adapters.lines(spark, sf_dir))


def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.reject_report(adapters.lines(spark, sf_dir))


def pick_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = packets.receive(adapters.lines(spark, sf_dir))
    return received.select("doc_id", "text", "original_text", "timestamp")


def received_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result_columns(_score_lines(spark, adapters.lines(spark, sf_dir)))


def _score_lines(spark: SparkSession, lines: DataFrame) -> DataFrame:
    return feed.score_lines(
        lines,
        adapters.lexicon(spark),
        scoring.PLAIN,
        adapters.WORDS,
        processed_at=F.lit("2025-01-01T00:00:00.000000"),
        processing_time=F.length("original_text") / F.lit(1e6),
    )


def _result_columns(results: DataFrame) -> DataFrame:
    return results.select(
        "client", "seq", "tweet_id", "stream_id", F.md5("text").alias("text_md5"),
        F.length("original_text").cast("bigint").alias("original_length"), "timestamp", "processed_at",
        "polarity_score", "polarity_subjectivity", "polarity_sentiment", "compound_score", "compound_positive",
        "compound_negative", "compound_neutral", "compound_sentiment", "processing_time",
    )


# -- scoring ------------------------------------------------------------------


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.tokenize(adapters.clean(spark, sf_dir)).withColumn("pos", F.col("pos").cast("bigint"))


def _scores(level: int, words: Callable[[SparkSession], DataFrame] = adapters.lexicon) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = adapters.messages(spark, sf_dir).select("id", "text")
        scored = scoring.score_messages(source, words(spark), "text", level, adapters.WORDS)
        return _scored(scored)

    return query


def score_spiced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels on texts that also hold what prose rarely does: "but", capitals, marks, and no text at all."""
    turn = F.col("seq") % 5
    spiced = adapters.messages(spark, sf_dir).select(
        "id",
        F.when(turn == 1, F.concat("text", F.lit(" best but IDIOT!!")))
        .when(turn == 2, F.concat(F.lit("BEST trash no best BUT "), "text"))
        .when(turn == 3, F.concat("text", F.lit(" the best! and vile!!!!!")))
        .when(turn == 4, F.col("text"))
        .alias("text"),
    )
    return _scored(scoring.score_messages(spiced, adapters.lexicon(spark), "text", scoring.EMPHASIS, adapters.WORDS))


def _scored(scored: DataFrame) -> DataFrame:
    return scored.select(
        "id", "compound", "positive", "negative", "neutral", "polarity", "subjectivity",
        label_compound(F.col("compound")).alias("compound_sentiment"),
        label_polarity(F.col("polarity")).alias("polarity_sentiment"),
    )


def score_documents_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores with a lexicon too large for the plan, most of whose tokens no text has."""
    more = spark.range(lexicon.MAX_INDEX_ROWS + 1).select(
        F.concat(F.lit("zz"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("token"),
        F.lit(10).alias("valence_tenths"), F.lit(100).alias("polarity_thousandths"), F.lit(100).alias("subjectivity_thousandths"),
    )
    return _scores(scoring.PLAIN, lambda s: adapters.lexicon(s).unionByName(more))(spark, sf_dir)


def label_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (F.col("doc_id") % 401 - 200) / F.lit(2000.0)
    return adapters.table(spark, sf_dir, "documents").select(
        "doc_id",
        label_compound(value).alias("compound_sentiment"),
        label_polarity(value).alias("polarity_sentiment"),
        trend_label(value).alias("trend"),
    )


# -- statistics over results ----------------------------------------------------


def sentiment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.sentiment_totals(adapters.results(spark, sf_dir))


def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.assign_batches(adapters.results(spark, sf_dir)).select("client", "seq", "arrival", "batch_id")


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.batch_summary(adapters.results(spark, sf_dir))


def full_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.full_batches(adapters.results(spark, sf_dir)).select(
        "client", "batch_id", "seq", "compound_score", "compound_sentiment"
    )


def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.running_totals(adapters.results(spark, sf_dir))


def final_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.last_n_mean(adapters.results(spark, sf_dir))


def _interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results whose ``seq`` starts at 1 in every client, as the flows number them."""
    within = Window.partitionBy("client").orderBy("seq")
    return adapters.results(spark, sf_dir).withColumn("seq", F.row_number().over(within).cast("bigint")).repartition(5)


def final_sentiment_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.last_n_mean(_interleaved(spark, sf_dir))


def recent_trend_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.recent_trend(_interleaved(spark, sf_dir))


def running_totals_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.running_totals(adapters.results(spark, sf_dir), chunk_rows=SMALL_CHUNK)


def results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results of the flow, stored as JSON lines and read back."""
    path = new_shared_path(spark, "results-json")
    results = _score_lines(spark, adapters.lines(spark, sf_dir))
    files.write_results_json(results, path)
    return _result_columns(spark.read.schema(results.schema).json(path))


def results_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results of the flow, stored as CSV and read back."""
    path = new_shared_path(spark, "results-csv")
    results = _score_lines(spark, adapters.lines(spark, sf_dir))
    files.write_results_csv(results, path)
    return _result_columns(files.read_results_csv(spark, path, results.schema))


def full_batches_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete batches, stored as JSON lines and read back."""
    path = new_shared_path(spark, "full-batches")
    results = adapters.results(spark, sf_dir)
    files.write_full_batches(results, path)
    schema = results.schema.add("batch_id", T.LongType())
    return spark.read.schema(schema).json(path).select("client", "batch_id", "seq", "compound_score", "compound_sentiment")


def full_batches_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete batches in folders by range; writing the same results again replaces them."""
    path = new_shared_path(spark, "batch-ranges")
    results = stored(adapters.results(spark, sf_dir), "results")
    for _ in range(2):
        files.write_batch_ranges(results, path, batches_per_folder=5)
    schema = results.schema.add("batch_id", T.LongType()).add("batch_range", T.LongType())
    return spark.read.schema(schema).json(path).select("client", "batch_id", "seq", "compound_score", "compound_sentiment")


def batch_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.batch_reports(adapters.results(spark, sf_dir))


def batch_reports_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.batch_reports(adapters.results(spark, sf_dir), chunk_rows=SMALL_CHUNK)


# -- the same in Spark SQL, over views and functions of the session ---------------------


def sql_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql.register_functions(spark)
    adapters.table(spark, sf_dir, "documents").createOrReplaceTempView("moodline_documents")
    return spark.sql("""
SELECT doc_id, compound_label(x) AS compound_sentiment, polarity_label(x) AS polarity_sentiment, trend_label(x) AS trend
FROM (SELECT doc_id, (doc_id % 401 - 200) / 2000D AS x FROM moodline_documents)""")


def sql_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql.register_functions(spark)
    sql.register_results(spark, adapters.results(spark, sf_dir), "moodline_")
    return spark.sql("""
WITH sums AS (
  SELECT client, batch_id, count(*) AS batch_size, count_if(compound_sentiment = 'positive') AS positive_count,
         count_if(compound_sentiment = 'negative') AS negative_count, count_if(compound_sentiment = 'neutral') AS neutral_count,
         sum(CAST(round(compound_score * 10000) AS BIGINT)) / count(*) / 10000D AS mean_compound,
         sum(CAST(round(processing_time * 1000000) AS BIGINT)) / count(processing_time) / 1000D AS mean_processing_ms,
         (unix_micros(max(event_time)) - unix_micros(min(event_time))) / 1000000D AS duration_s
  FROM moodline_results GROUP BY client, batch_id)
SELECT *, positive_count / batch_size * 100 AS positive_pct, negative_count / batch_size * 100 AS negative_pct,
       neutral_count / batch_size * 100 AS neutral_pct, trend_label(mean_compound) AS trend
FROM sums""")


def sql_session_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql.register_log(spark, adapters.log(spark, sf_dir), "moodline_")
    return spark.sql("""
SELECT client, session, sent, (unix_micros(disconnected_at) - unix_micros(connected_at)) / 1000000D AS duration_s
FROM moodline_sessions WHERE disconnected_at IS NOT NULL""")


def received_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire lines stored as text and read back, then received and scored."""
    path = new_shared_path(spark, "wire")
    files.write_packets(adapters.lines(spark, sf_dir), path)
    return _result_columns(_score_lines(spark, files.read_packets(spark, path)))


def final_sentiment_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.last_n_mean(adapters.results(spark, sf_dir), n=20, keys=["client"])


def recent_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.recent_trend(adapters.results(spark, sf_dir))


def recent_trend_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.recent_trend(adapters.results(spark, sf_dir), keys=["client"])


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("client"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("event_time"),
        (F.col("value") / 1000).alias("processing_time"),
    )


def processing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.processing_stats(_event_times(spark, sf_dir))


def processing_stats_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.processing_stats(_event_times(spark, sf_dir), n=50, keys=["client"])


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = batches.assign_batches(adapters.results(spark, sf_dir))
    in_batch = (F.col("arrival") - 1) % batches.BATCH_SIZE + 1
    label = F.col("compound_sentiment")
    return batched.select(
        "client",
        "seq",
        clip(F.col("text"), 120).alias("shown_text"),
        F.concat_ws(" ", report.symbol(label), F.upper(label)).alias("shown_label"),
        F.round("compound_score", 3).alias("shown_score"),
        F.round(F.col("processing_time") * 1000, 3).alias("shown_ms"),
        report.progress_bar(in_batch.cast("int")).alias("progress"),
        report.clock(F.col("event_time")).alias("shown_time"),
        report.thousands(F.col("seq") * 1000).alias("shown_count"),
    )


def report_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = adapters.results(spark, sf_dir)
    return results.select(
        "client",
        "seq",
        report.signed(F.col("compound_score"), 4).alias("shown_signed"),
        report.percent_text(F.col("seq") % 8, F.lit(8)).alias("shown_percent"),
        report.millis_text(F.col("processing_time"), 3).alias("shown_ms"),
        report.iso_text(F.col("event_time")).alias("shown_iso"),
        report.file_stamp(F.col("event_time")).alias("shown_stamp"),
    )


# -- delivery log ---------------------------------------------------------------


def log_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.log_totals(adapters.log(spark, sf_dir)).withColumn("last_activity", _time("last_activity"))


def active_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.active_connections(adapters.log(spark, sf_dir)).select("seq", "action", "active")


def active_connections_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = delivery.active_connections(adapters.log(spark, sf_dir), chunk_rows=SMALL_CHUNK)
    return counted.select("seq", "action", "active")


def packet_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.packet_counters(adapters.log(spark, sf_dir)).select("seq", "total_sent_before", "active_clients")


def trailing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.trailing_rate(adapters.log(spark, sf_dir)).select("seq", "sends", "sends_capped")


def trailing_rate_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = delivery.trailing_rate(adapters.log(spark, sf_dir), RATE_WINDOW_OF_TEST_S, cap=5)
    return rated.select("seq", "sends", "sends_capped")


def trailing_rate_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = delivery.rate_by_client(adapters.log(spark, sf_dir), window_s=24 * RATE_WINDOW_OF_TEST_S)
    return rated.select("client", "seq", "sends")


def client_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = delivery.client_stats(adapters.log(spark, sf_dir))
    return stats.select(
        "client", "session", "sent", _time("connected_at"), _time("last_sent_at"), "connected_s", "status"
    )


def session_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.session_durations(adapters.log(spark, sf_dir))


def connection_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.connection_history(adapters.log(spark, sf_dir))


def shown_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.shown_history(adapters.log(spark, sf_dir))


def average_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.average_rate(adapters.log(spark, sf_dir))


def session_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = delivery.session_cap(adapters.log(spark, sf_dir), n=CAP_OF_TEST)
    return capped.select("client", "session", "seq", F.col("delivery").cast("bigint").alias("delivery"))


def status_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.status_snapshot(adapters.log(spark, sf_dir), adapters.clean(spark, sf_dir))


# -- sampling and the whole way from draw to summary -------------------------------


def draw_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drawn(spark, sf_dir).select("client", F.col("draw").cast("bigint").alias("draw"), "id", "stream_id")


def _drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.draw_with_replacement(
        adapters.clean(spark, sf_dir).drop("client"), adapters.sessions(spark, sf_dir), seed=SAMPLE_SEED, order=["seq"]
    )


def serve_and_analyse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw, wrap, encode, receive, score and summarise in batches of ten."""
    lines = flows.serve(
        adapters.messages(spark, sf_dir).drop("client"),
        adapters.sessions(spark, sf_dir),
        seed=SAMPLE_SEED,
        order=("seq",),
        stream_timestamp=F.substring("created_at", 1, 19),
    )
    seconds = F.length("original_text") / F.lit(1e6)
    return flows.analyse(lines, adapters.lexicon(spark), scoring.PLAIN, adapters.WORDS, seconds)


# -- streaming --------------------------------------------------------------------


def _line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "lines")
    files.write_packets(adapters.lines(spark, sf_dir), path)
    return files.stream_packets(spark, path, _ALL_FILES)


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "log")
    log = adapters.log(spark, sf_dir)
    log.write.parquet(path)
    return spark.readStream.schema(log.schema).parquet(path)


def _run(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    out = new_shared_path(spark, label)
    feed.write_by_epoch(stream, out, new_shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).drop("epoch")


def _run_complete(spark: SparkSession, counters: DataFrame, label: str) -> DataFrame:
    out = new_shared_path(spark, label)

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    monitor.start_monitor(counters, keep, new_shared_path(spark, "checkpoint"), every=None).awaitTermination()
    return spark.read.parquet(out)


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result_columns(_run(spark, _score_lines(spark, _line_stream(spark, sf_dir)), "scores"))


def _turn(df: DataFrame, value: Column, turns: int) -> Column:
    """The share of the range of ``value`` that a row lies in, 0 … ``turns`` - 1; 0 without a value."""
    ends = df.agg(F.min(value).alias("least"), F.max(value).alias("greatest")).first()
    width = ((ends["greatest"] or 0) - (ends["least"] or 0) + 1) / turns
    return F.coalesce(F.floor((value - F.lit(ends["least"] or 0)) / F.lit(width)).cast("int"), F.lit(0))


def _run_turns(spark: SparkSession, df: DataFrame, turn: Column, turns: int, step: epochs.Step, prepare: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Let ``df`` arrive in several turns, each a micro-batch that goes on from the checkpoint of the one before."""
    source, out, checkpoint = (new_shared_path(spark, label) for label in ("arriving", "live", "checkpoint"))
    for k in range(turns):
        df.filter(turn == k).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        epochs.start_epochs(prepare(stream) if prepare else stream, step, out, checkpoint).awaitTermination()
    return out


def _scored_stream(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    return lambda lines: _score_lines(spark, lines.drop("doc_id")).withColumn("event_time", F.try_to_timestamp("timestamp"))


def stream_batches(spark: SparkSession, sf_dir: str, turns: int = BATCH_TURNS) -> DataFrame:
    lines = adapters.lines(spark, sf_dir)
    turn = _turn(adapters.table(spark, sf_dir, "documents"), F.col("doc_id"), turns)
    out = _run_turns(spark, lines, turn, turns, live_batches.batch_step(), _scored_stream(spark))
    return epochs.read_finished(spark, out, "batches").drop("epoch")


def stream_batches_shuffled(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    """Results that arrive in no order: the reorder buffer gives the batches of the batch form."""
    results = _received_in_order(spark, sf_dir)
    turn = F.pmod(F.xxhash64("client", "seq"), F.lit(turns))
    step = live_batches.in_order(live_batches.batch_step(), patience=turns + 1)
    out = _run_turns(spark, results, turn, turns, step)
    return epochs.read_finished(spark, out, "batches").drop("epoch")


def _received_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored results of the wire lines, numbered from 1 in every client."""
    scored = _scored_stream(spark)(adapters.lines(spark, sf_dir))
    within = Window.partitionBy("client").orderBy("seq")
    columns = ["client", "compound_score", "compound_sentiment", "processing_time", "event_time"]
    return stored(scored.select(*columns, F.row_number().over(within).cast("bigint").alias("seq")), "received")


def _live_log(spark: SparkSession, sf_dir: str, step: epochs.Step, turns: int) -> str:
    log = adapters.log(spark, sf_dir)
    return _run_turns(spark, log, _turn(log, F.unix_micros("event_time"), turns), turns, step)


def stream_sessions(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    return live_log.finished_sessions(spark, _live_log(spark, sf_dir, live_log.session_step(), turns))


def stream_client_stats(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    stats = live_log.client_stats(spark, _live_log(spark, sf_dir, live_log.session_step(), turns))
    return stats.select("client", "session", "sent", _time("connected_at"), _time("last_sent_at"), "connected_s", "status")


def stream_trailing_rate(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    rates = live_log.trailing_rates(spark, _live_log(spark, sf_dir, live_log.trailing_rate_step(), turns))
    return rates.select("seq", "sends", "sends_capped")


def stream_trailing_rate_hour(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    """A longer window, and sends that are rated an hour late."""
    step = live_log.trailing_rate_step(RATE_WINDOW_OF_TEST_S, 5, lateness_s=3600)
    rates = live_log.trailing_rates(spark, _live_log(spark, sf_dir, step, turns), RATE_WINDOW_OF_TEST_S, 5)
    return rates.select("seq", "sends", "sends_capped")


def stream_connection_history(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    return live_log.connection_history(spark, _live_log(spark, sf_dir, live_log.history_step(), turns))


def stream_snapshot(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    """One stored stream, four steps: the status row comes with sessions, rates and history."""
    step = epochs.combined(
        live_log.snapshot_step(adapters.clean(spark, sf_dir)), live_log.session_step(), live_log.trailing_rate_step(), live_log.history_step()
    )
    return live_log.status_snapshot(spark, _live_log(spark, sf_dir, step, turns))


def stream_compacted(spark: SparkSession, sf_dir: str, turns: int = TURNS) -> DataFrame:
    """Finished sessions of a stream whose epochs have been brought together."""
    out = _live_log(spark, sf_dir, live_log.session_step(), turns)
    epochs.compact(spark, out)
    epochs.remove_compacted(spark, out)
    return live_log.finished_sessions(spark, out)


def _stream_full(spark: SparkSession, sf_dir: str) -> str:
    results = _score_lines(spark, _line_stream(spark, sf_dir))
    timed = results.withColumn("event_time", F.try_to_timestamp("timestamp"))
    out = new_shared_path(spark, "full-batches")
    full_batches_stream.start_full_batches(timed, out, new_shared_path(spark, "checkpoint")).awaitTermination()
    return out


def stream_full_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = full_batches_stream.read_full_batches(spark, _stream_full(spark, sf_dir))
    return rows.select("client", "batch_id", "seq", "compound_score", "compound_sentiment")


def stream_all_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of all batches of a stream, the short last ones included."""
    rows = full_batches_stream.read_all_batches(spark, _stream_full(spark, sf_dir))
    return batches.summarise_batches(rows)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a packet stream that cannot be decoded, stored and counted."""
    out = new_shared_path(spark, "rejects")
    feed.start_rejects(_line_stream(spark, sf_dir), out, new_shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("bad_lines"))


def stream_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _score_lines(spark, _line_stream(spark, sf_dir))
    return _run_complete(spark, monitor.live_label_counts(results), "labels")


def stream_sends_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates in update mode: windows older than the lateness leave the state, and the last word on each counts."""
    out = new_shared_path(spark, "rates")
    rates = monitor.sends_per_minute(_log_stream(spark, sf_dir))
    feed.write_by_epoch(rates, out, new_shared_path(spark, "checkpoint"), output_mode="update").awaitTermination()
    last = spark.read.parquet(out).groupBy("at").agg(F.max_by("sends", "epoch").alias("sends"))
    return last.select(_time("at"), "sends")


def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = _run_complete(spark, monitor.live_status(_log_stream(spark, sf_dir)), "status")
    return status.withColumn("last_activity", _time("last_activity"))


QUERIES: dict[str, Query] = {
    "read_messages": read_messages,
    "clean_messages": clean_messages,
    "preview": preview,
    "build_packets": build_packets,
    "packet_json": packet_json,
    "parse_packets": parse_packets,
    "rejected_lines": rejected_lines,
    "drop_control": drop_control,
    "control_messages": control_messages,
    "reject_report": reject_report,
    "pick_text": pick_text,
    "received_results": received_results,
    "tokens": tokens,
    "score_documents": _scores(scoring.PLAIN),
    "score_negation": _scores(scoring.NEGATION),
    "score_boosters": _scores(scoring.BOOSTERS),
    "score_emphasis": _scores(scoring.EMPHASIS),
    "score_documents_joined": score_documents_joined,
    "score_spiced": score_spiced,
    "label_boundaries": label_boundaries,
    "sentiment_totals": sentiment_totals,
    "assign_batches": assign_batches,
    "batch_summary": batch_summary,
    "full_batches": full_batches,
    "running_totals": running_totals,
    "running_totals_chunked": running_totals_chunked,
    "final_sentiment": final_sentiment,
    "final_sentiment_interleaved": final_sentiment_interleaved,
    "recent_trend_interleaved": recent_trend_interleaved,
    "results_json": results_json,
    "results_csv": results_csv,
    "full_batches_file": full_batches_file,
    "full_batches_ranges": full_batches_ranges,
    "batch_reports": batch_reports,
    "batch_reports_chunked": batch_reports_chunked,
    "sql_labels": sql_labels,
    "sql_batch_summary": sql_batch_summary,
    "sql_session_durations": sql_session_durations,
    "received_from_files": received_from_files,
    "final_sentiment_by_client": final_sentiment_by_client,
    "recent_trend": recent_trend,
    "recent_trend_by_client": recent_trend_by_client,
    "processing_stats": processing_stats,
    "processing_stats_by_client": processing_stats_by_client,
    "report_lines": report_lines,
    "report_values": report_values,
    "log_totals": log_totals,
    "active_connections": active_connections,
    "active_connections_chunked": active_connections_chunked,
    "packet_counters": packet_counters,
    "trailing_rate": trailing_rate,
    "trailing_rate_hour": trailing_rate_hour,
    "trailing_rate_by_client": trailing_rate_by_client,
    "client_stats": client_stats,
    "session_durations": session_durations,
    "connection_history": connection_history,
    "shown_history": shown_history,
    "average_rate": average_rate,
    "session_cap": session_cap,
    "status_snapshot": status_snapshot,
    "draw_with_replacement": draw_with_replacement,
    "serve_and_analyse": serve_and_analyse,
    "stream_scores": stream_scores,
    "stream_batches": stream_batches,
    "stream_batches_shuffled": stream_batches_shuffled,
    "stream_sessions": stream_sessions,
    "stream_client_stats": stream_client_stats,
    "stream_trailing_rate": stream_trailing_rate,
    "stream_trailing_rate_hour": stream_trailing_rate_hour,
    "stream_connection_history": stream_connection_history,
    "stream_snapshot": stream_snapshot,
    "stream_compacted": stream_compacted,
    "stream_full_batches": stream_full_batches,
    "stream_all_batches": stream_all_batches,
    "stream_rejects": stream_rejects,
    "stream_label_counts": stream_label_counts,
    "stream_sends_per_minute": stream_sends_per_minute,
    "stream_status": stream_status,
}
