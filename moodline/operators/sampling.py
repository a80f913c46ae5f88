"""Random draws with replacement, repeatable from a seed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.operators.ordered import CHUNK_ROWS, with_index

DRAWS = 50
STREAM_ID_LOW, STREAM_ID_COUNT = 10_000, 90_000

_HEX_DIGITS = 15


def hashed(*parts: Column) -> Column:
    """A 60-bit number from the text of the parts, the same in every engine that has md5."""
    text = F.concat_ws("|", *[part.cast("string") for part in parts])
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def draw_with_replacement(
    messages: DataFrame,
    sessions: DataFrame,
    n: int = DRAWS,
    seed: int = 0,
    session: str = "client",
    order: Sequence[str] = ("id",),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``n`` uniform draws of messages for every row of ``sessions``.

    Adds ``draw`` (from 1) and ``stream_id``. Only the order columns, which must be unique
    and known, are numbered; a draw meets a number, which the hash spreads evenly, and its
    message by the order columns after. Without messages there are no draws.

    A session is a few bytes and its draws are ``n`` texts: partitions by the size of what
    is read would leave the work to a few tasks, so draws and messages are dealt to all
    ``spark.sql.shuffle.partitions``.
    """
    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = messages.agg(F.count(F.lit(1)).alias("n")).scalar()
    draws = (
        sessions.select(session).repartition(parts).select(session, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("draw"))
        .withColumn("_idx", F.pmod(hashed(F.lit(seed), F.col(session), F.col("draw")), F.nullif(total, F.lit(0))))
        .withColumn("stream_id", stream_id(seed, F.col(session), F.col("draw")))
    )
    named = {c: f"_order_{i}" for i, c in enumerate(order)}
    numbers = with_index(messages.select(*order), order, "_idx", chunk_rows).withColumnsRenamed(named)
    placed = draws.join(numbers, "_idx").drop("_idx")
    dealt = messages.repartition(parts, *order)
    same = reduce(and_, [dealt[c] == F.col(alias) for c, alias in named.items()])
    return placed.repartition(parts, *named.values()).join(dealt, same).drop(*named.values())


def stream_id(seed: int, session: Column, draw: Column) -> Column:
    """A number from 10000 to 99999; not unique."""
    ids = hashed(F.lit(seed), F.lit("stream"), session, draw)
    return (F.pmod(ids, F.lit(STREAM_ID_COUNT)) + STREAM_ID_LOW).cast("int")
