"""Views of the test tables as messages, results, wire lines and a delivery log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.functions.labels import label_compound
from moodline.operators.lexicon import lexicon_from_rows
from moodline.operators.messages import clean_messages
from moodline.operators.packets import build_packets, encode_packets
from moodline.operators.scoring import PLAIN, Words, score_messages
from moodline.schemas import CONNECTED, DISCONNECTED, ERROR, SENT

# Fixed values of the fixtures.
NEGATIVE_WORDS = "idiot trash scum worthless stupid moron loser pathetic disgusting vile clown".split()
POSITIVE_WORDS = "best hehely thatin inoran rewh ononst".split()
LEXICON_ROWS = [(w, -20, -500, 800) for w in NEGATIVE_WORDS] + [(w, 15, 400, 600) for w in POSITIVE_WORDS]
WORDS = Words(negators=["no"], raisers=["the"], dampers=["and"])
ACTIONS = {"signup": CONNECTED, "purchase": DISCONNECTED, "view": SENT, "click": SENT, "error": ERROR}

# What happens to a wire line, by document number modulo 50.
LINE_CYCLE = 50
WELCOME, COMPLETION, CUT, NULL_TYPE, EMPTY_CLEAN, FILLED_CLEAN = range(6)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_from_rows(spark, LEXICON_ROWS)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as stored messages, with ``client``, ``seq`` and ``n_chars``."""
    metrics = F.struct(
        (F.col("doc_id") % 97).alias("like_count"),
        (F.col("doc_id") % 7).alias("bookmark_count"),
        (F.col("doc_id") % 11).alias("reply_count"),
        (F.col("doc_id") % 3).alias("quote_count"),
        (F.col("n_chars") % 13).alias("retweet_count"),
        (F.col("n_chars") % 1009).alias("impression_count"),
    )
    created = F.expr("timestampadd(SECOND, doc_id, TIMESTAMP_NTZ '2025-01-01 00:00:00')")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        "text",
        F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("created_at"),
        F.col("source").alias("author_id"),
        "lang",
        F.when(F.col("doc_id") % 25 != 7, metrics).alias("public_metrics"),
        F.array(F.struct(F.col("lang").alias("domain"), F.col("source").alias("entity"))).alias("context_annotations"),
        F.col("source").alias("client"),
        F.col("doc_id").alias("seq"),
        "n_chars",
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_messages(messages(spark, sf_dir))


def results(spark: SparkSession, sf_dir: str, level: int = PLAIN) -> DataFrame:
    """Scored clean messages with the columns that the statistics need."""
    scored = score_messages(clean(spark, sf_dir), lexicon(spark), "text", level, WORDS)
    return scored.select(
        "client",
        "seq",
        "text",
        F.to_timestamp("created_at").alias("event_time"),
        F.col("compound").alias("compound_score"),
        label_compound(F.col("compound")).alias("compound_sentiment"),
        F.col("polarity").alias("polarity_score"),
        (F.col("n_chars") / F.lit(1e6)).alias("processing_time"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a delivery log in the order of ``seq``."""
    action: Column | None = None
    for event_type, name in ACTIONS.items():
        matches = F.col("event_type") == event_type
        action = F.when(matches, name) if action is None else action.when(matches, name)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("user_id").cast("string").alias("client"),
        action.alias("action"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One client per conversation."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("client")).distinct()


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packet per message, with fixed times and counters."""
    return build_packets(
        messages(spark, sf_dir),
        stream_id=F.col("seq") % 90_000 + 10_000,
        stream_timestamp=F.substring("created_at", 1, 19),
        active_clients=F.col("seq") % 5,
        total_sent=F.col("seq"),
        uptime=F.col("seq") / 2,
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire lines of all messages with their ``doc_id``; some are control messages, cut short or odd."""
    kind = F.col("seq") % LINE_CYCLE
    clean_text = F.when(kind == EMPTY_CLEAN, "").when(kind == FILLED_CLEAN, F.concat(F.lit("best "), F.col("text")))
    encoded = encode_packets(packets(spark, sf_dir).withColumn("clean_text", clean_text), keep=["seq"])
    number = F.col("seq").cast("string")
    welcome = F.struct(
        F.lit("welcome").alias("type"),
        F.concat(F.lit("hello "), number).alias("message"),
        F.col("seq").alias("total_tweets_available"),
    )
    completion = F.struct(
        F.lit("completion").alias("type"), F.concat(F.lit("done "), number).alias("message")
    )
    half = (F.length("value") / 2).cast("int")
    line = (
        F.when(kind == WELCOME, F.to_json(welcome))
        .when(kind == COMPLETION, F.to_json(completion))
        .when(kind == CUT, F.substring("value", F.lit(1), half))
        .when(kind == NULL_TYPE, F.concat(F.lit('{"type":null,'), F.substring("value", F.lit(2), F.length("value"))))
        .otherwise(F.col("value"))
    )
    return encoded.select(F.col("seq").alias("doc_id"), line.alias("value"))
