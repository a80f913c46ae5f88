"""The two ways through the library, as compositions of its operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.operators.batches import batch_summary
from moodline.operators.messages import clean_messages
from moodline.operators.packets import build_packets, encode_packets
from moodline.operators.sampling import DRAWS, draw_with_replacement
from moodline.operators.scoring import DEFAULT_WORDS, EMPHASIS, Words
from moodline.streaming.feed import score_lines


def serve(
    messages: DataFrame,
    sessions: DataFrame,
    n: int = DRAWS,
    seed: int = 0,
    order: tuple[str, ...] = ("id",),
    stream_timestamp: Column | None = None,
) -> DataFrame:
    """Stored messages to wire lines: clean, draw ``n`` for every session, wrap, encode."""
    clean = clean_messages(messages)
    drawn = draw_with_replacement(clean, sessions, n, seed, order=order).withColumn("seq", F.col("draw"))
    return encode_packets(build_packets(drawn, stream_timestamp=stream_timestamp))


def analyse(
    lines: DataFrame,
    lexicon: DataFrame,
    level: int = EMPHASIS,
    words: Words = DEFAULT_WORDS,
    processing_time: Column | None = None,
) -> DataFrame:
    """Wire lines to batch summaries: receive, score, label, and summarise every ten of a client."""
    results = score_lines(lines, lexicon, level, words, processing_time=processing_time)
    return batch_summary(results.withColumn("event_time", F.try_to_timestamp("timestamp")))
