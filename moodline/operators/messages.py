"""Cleaning of the stored message table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.text import clip_always

PACKET_COLUMNS = ["id", "text", "created_at", "author_id", "public_metrics"]


def is_clean(lang: str = "en", min_len: int = 20) -> Column:
    """Text present, in the language, and longer than ``min_len`` characters."""
    return F.col("text").isNotNull() & (F.col("lang") == lang) & (F.length("text") > min_len)


def clean_messages(messages: DataFrame, lang: str = "en", min_len: int = 20) -> DataFrame:
    """Keep the messages that may be delivered, with all their columns."""
    return messages.filter(is_clean(lang, min_len))


def select_packet_columns(messages: DataFrame, *extra: str) -> DataFrame:
    """The columns a packet is made from, and any ``extra`` ones such as an order."""
    return messages.select(*PACKET_COLUMNS, *extra)


def with_created_ts(messages: DataFrame) -> DataFrame:
    """Add the parsed creation time; NULL where the text is not a time."""
    return messages.withColumn("created_ts", F.try_to_timestamp("created_at"))


def preview(messages: DataFrame, order: list[str], n: int = 3, chars: int = 60) -> DataFrame:
    """The first ``n`` messages in the given order: id and start of the text."""
    return messages.orderBy(*order).limit(n).select("id", clip_always(F.col("text"), chars).alias("text"))
