"""Analytics over the delivery log: counters, rates, connections and sessions.

``log`` has ``event_time``, ``client`` and ``action``, and an order that is unique over
the whole log (``order``; of integer type, or ``event_time`` itself).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.functions.report import clock, seconds_between
from moodline.operators.ordered import CHUNK_ROWS, running_values, trailing_counts
from moodline.schemas import CONNECTED, DISCONNECTED, ERROR, SENT

# Fixed values.
RATE_WINDOW_S = 60
RATE_RING = 60
HISTORY_RING = 100
HISTORY_SHOWN = 3
SESSION_CAP = 50
STREAMING = "STREAMING"
WAITING = "WAITING"

DEFAULT_ORDER = ("_micros", "seq")


def is_action(action: str) -> Column:
    return F.coalesce(F.col("action") == action, F.lit(False))


def _one_if(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _with_micros(log: DataFrame) -> DataFrame:
    return log.withColumn("_micros", F.unix_micros("event_time"))


def _connection_step() -> Column:
    return F.when(is_action(CONNECTED), 1).when(is_action(DISCONNECTED), -1).otherwise(0).cast("bigint")


def log_totals(log: DataFrame) -> DataFrame:
    """Sends, connections, errors and the time of the last activity."""
    return log.agg(
        F.count_if(is_action(SENT)).alias("total_sent"),
        F.count_if(is_action(CONNECTED)).alias("total_connections"),
        F.count_if(is_action(ERROR)).alias("errors"),
        F.max("event_time").alias("last_activity"),
    )


def active_connections(
    log: DataFrame, order: Sequence[str] = DEFAULT_ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """After every event, connects less disconnects so far."""
    return running_values(
        _with_micros(log), [], list(order), {"active": _connection_step()}, chunk_rows=chunk_rows
    ).drop("_micros")


def packet_counters(
    log: DataFrame, order: Sequence[str] = DEFAULT_ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """For every send, the number of sends before it and the connections open then."""
    sent = _one_if(is_action(SENT))
    counted = running_values(
        _with_micros(log),
        [],
        list(order),
        {"total_sent_before": sent, "active_clients": _connection_step()},
        chunk_rows=chunk_rows,
    )
    return (
        counted.filter(is_action(SENT))
        .withColumn("total_sent_before", F.col("total_sent_before") - 1)
        .drop("_micros")
    )


def trailing_rate(
    log: DataFrame,
    window_s: int = RATE_WINDOW_S,
    cap: int | None = RATE_RING,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("seq",),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """At every send, the sends of the last ``window_s`` seconds, and the same up to ``cap``.

    Strictly newer than ``window_s`` ago. The cap is the length of the history that
    the rate is read from.
    """
    sends = _with_micros(log.filter(is_action(SENT)))
    rated = trailing_counts(sends, list(keys), "_micros", list(order), window_s * 1_000_000, "sends", chunk_rows)
    capped = F.col("sends") if cap is None else F.least(F.col("sends"), F.lit(cap).cast("bigint"))
    return rated.withColumn("sends_capped", capped).drop("_micros")


def rate_by_client(
    log: DataFrame, window_s: int = RATE_WINDOW_S, order: Sequence[str] = ("seq",), chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """At every send, the sends to the same client in the last ``window_s`` seconds."""
    return trailing_rate(log, window_s, None, ["client"], order, chunk_rows).drop("sends_capped")


def with_sessions(
    log: DataFrame, order: Sequence[str] = DEFAULT_ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add ``session``, the number of connects of the client so far, and ``in_session``.

    An event is in a session if the client's latest connect or disconnect, the event
    itself included, is a connect. Events without a client are left out.
    """
    marker = F.struct(*order, is_action(CONNECTED).alias("open"))
    numbered = running_values(
        _with_micros(log.filter(F.col("client").isNotNull())),
        ["client"],
        list(order),
        {"session": _one_if(is_action(CONNECTED))},
        {"_latest": F.when(is_action(CONNECTED) | is_action(DISCONNECTED), marker)},
        chunk_rows=chunk_rows,
    )
    return numbered.withColumn("in_session", F.coalesce("_latest.open", F.lit(False))).drop("_latest", "_micros")


def sessions(log: DataFrame, order: Sequence[str] = DEFAULT_ORDER, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per session: start, first disconnect, last send and sends while it was open."""
    sent = is_action(SENT) & F.col("in_session")
    return (
        with_sessions(log, order, chunk_rows)
        .filter(F.col("session") > 0)
        .groupBy("client", "session")
        .agg(
            F.min(F.when(is_action(CONNECTED), F.col("event_time"))).alias("connected_at"),
            F.min(F.when(is_action(DISCONNECTED), F.col("event_time"))).alias("disconnected_at"),
            F.max(F.when(sent, F.col("event_time"))).alias("last_sent_at"),
            F.count_if(sent).alias("sent"),
        )
    )


def session_durations(
    log: DataFrame, order: Sequence[str] = DEFAULT_ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Sends and seconds of every finished session."""
    finished = sessions(log, order, chunk_rows).filter(F.col("disconnected_at").isNotNull())
    duration = seconds_between(F.col("connected_at"), F.col("disconnected_at"))
    return finished.select("client", "session", "sent", duration.alias("duration_s"))


def client_stats(
    log: DataFrame,
    now: datetime | None = None,
    order: Sequence[str] = DEFAULT_ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The open session of every connected client, as of ``now`` or of the last event.

    A client that connects again replaces its earlier session.
    """
    columns = ["session", "connected_at", "disconnected_at", "last_sent_at", "sent"]
    latest = sessions(log, order, chunk_rows).groupBy("client").agg(
        F.max_by(F.struct(*columns), F.col("session")).alias("s")
    )
    at = _now(log, now)
    return latest.filter(F.col("s.disconnected_at").isNull()).select(
        "client",
        "s.session",
        "s.sent",
        "s.connected_at",
        "s.last_sent_at",
        seconds_between(F.col("s.connected_at"), at).alias("connected_s"),
        F.lit("streaming").alias("status"),
    )


def session_cap(
    log: DataFrame, n: int = SESSION_CAP, order: Sequence[str] = DEFAULT_ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The first ``n`` deliveries of every session.

    Every task keeps ``n`` rows per session before the shuffle, so a hot session stays small.
    """
    sends = _with_micros(with_sessions(log, order, chunk_rows).filter(is_action(SENT) & F.col("in_session")))
    rank = F.row_number().over(Window.partitionBy("client", "session").orderBy(*order))
    return sends.withColumn("delivery", rank).filter(F.col("delivery") <= n).drop("_micros", "in_session")


def connection_history(
    log: DataFrame,
    n: int = HISTORY_SHOWN,
    keep: int = HISTORY_RING,
    order: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """The latest connects and disconnects, at most ``n`` of the ``keep`` remembered ones."""
    changes = _with_micros(log.filter(is_action(CONNECTED) | is_action(DISCONNECTED)))
    return (
        changes.orderBy(*[F.col(c).desc() for c in order])
        .limit(min(n, keep))
        .select(
            clock(F.col("event_time")).alias("at"),
            F.substring_index("client", ":", 1).alias("client_ip"),
            F.when(is_action(CONNECTED), "connect").otherwise("disconnect").alias("action"),
        )
    )


def shown_history(
    log: DataFrame, n: int = HISTORY_SHOWN, order: Sequence[str] = DEFAULT_ORDER
) -> DataFrame:
    """The latest ``n`` connects and disconnects as they are shown: ``place`` 1 is the oldest of them."""
    changes = _with_micros(log.filter(is_action(CONNECTED) | is_action(DISCONNECTED)))
    latest = changes.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    # n rows at most
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("bigint")
    action = F.when(is_action(CONNECTED), "connect").otherwise("disconnect")
    return latest.select(place.alias("place"), clock(F.col("event_time")).alias("at"), F.substring_index("client", ":", 1).alias("client_ip"), action.alias("action"))


def _now(log: DataFrame, now: datetime | None) -> Column:
    """Time of asking; by default that of the last event, as a scalar subquery."""
    return F.lit(now) if now is not None else log.agg(F.max("event_time").alias("now")).scalar()


def _start(log: DataFrame, start: datetime | None) -> Column:
    return F.lit(start) if start is not None else log.agg(F.min("event_time").alias("start")).scalar()


def _rates(total: Column, uptime: Column, ring: int = RATE_RING) -> list[Column]:
    """Sends per minute over the uptime, and of the remembered sends over their minute at most."""
    ringed = F.least(total, F.lit(ring).cast("bigint"))
    recent = ringed / F.nullif(F.least(uptime, F.lit(60.0)), F.lit(0.0)) * 60
    return [
        (total / F.nullif(uptime / 60, F.lit(0.0))).alias("average_rate"),
        F.coalesce(recent, F.lit(0.0)).alias("recent_average_rate"),
    ]


def average_rate(log: DataFrame, start: datetime | None = None, now: datetime | None = None) -> DataFrame:
    """One row: uptime, sends and the two average rates; NULL and 0 without uptime.

    By default the log's own first and last event bound the uptime.
    """
    totals = log.agg(
        F.count_if(is_action(SENT)).alias("total_sent"),
        F.min("event_time").alias("_first"),
        F.max("event_time").alias("_last"),
    )
    first = F.col("_first") if start is None else F.lit(start)
    last = F.col("_last") if now is None else F.lit(now)
    timed = totals.withColumn("uptime_s", F.coalesce(seconds_between(first, last), F.lit(0.0)))
    return timed.select("uptime_s", "total_sent", *_rates(F.col("total_sent"), F.col("uptime_s")))


def status_snapshot(
    log: DataFrame, messages: DataFrame, start: datetime | None = None, now: datetime | None = None
) -> DataFrame:
    """The dashboard in one row, as of ``now``: one aggregation, other numbers by subquery."""
    at, first = _now(log, now), _start(log, start)
    minute_ago = at - F.make_dt_interval(mins=F.lit(1))
    totals = log.filter(F.col("event_time") <= at).agg(
        F.count_if(is_action(SENT)).alias("total_sent"),
        F.count_if(is_action(SENT) & (F.col("event_time") > minute_ago)).alias("_recent"),
        F.coalesce(F.sum(_connection_step()), F.lit(0)).alias("active_connections"),
        F.count_if(is_action(CONNECTED)).alias("total_connections"),
        F.count_if(is_action(ERROR)).alias("errors"),
    )
    timed = totals.withColumns(
        {
            "uptime_s": F.coalesce(seconds_between(first, at), F.lit(0.0)),
            "available": messages.agg(F.count(F.lit(1)).alias("n")).scalar(),
        }
    )
    return timed.select(*dashboard())


def dashboard() -> list[Column]:
    """The columns of a status row, from counters, ``uptime_s``, ``available`` and ``_recent``, the sends of the last minute."""
    return [
        F.col("uptime_s"),
        F.col("total_sent"),
        F.least(F.col("_recent"), F.lit(RATE_RING).cast("bigint")).alias("sends_per_minute"),
        F.col("active_connections"),
        F.col("total_connections"),
        F.col("errors"),
        F.col("available"),
        *_rates(F.col("total_sent"), F.col("uptime_s")),
        F.when(F.col("active_connections") > 0, STREAMING).otherwise(WAITING).alias("status"),
    ]
