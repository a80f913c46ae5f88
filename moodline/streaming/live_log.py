"""Live sessions, rates, history and status of a delivery-log stream, as steps of ``epochs``.

Each step gives, over any number of micro-batches, the rows that the batch operator of
``operators/delivery.py`` gives for the whole log. Events arrive by micro-batch; within
one, ``order`` holds. What a step carries is small: one row per client, the events of
the last minute, the latest changes, or one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.functions.report import seconds_between
from moodline.operators import delivery
from moodline.operators.delivery import DEFAULT_ORDER, HISTORY_RING, HISTORY_SHOWN, RATE_RING, RATE_WINDOW_S, is_action
from moodline.operators.ordered import CHUNK_ROWS, running_values, trailing_counts
from moodline.schemas import CONNECTED, DISCONNECTED, ERROR, SENT
from moodline.streaming.epochs import Keep, Step, Tables, read_carried, read_finished

_EVENT = "seq bigint, event_time timestamp, client string, action string"
_COLUMNS = ["seq", "event_time", "client", "action"]
_SESSION = "client string, session bigint, connected_at timestamp, disconnected_at timestamp, last_sent_at timestamp, sent bigint"


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


# -- sessions ---------------------------------------------------------------------


def session_step(order: Sequence[str] = DEFAULT_ORDER, chunk_rows: int = CHUNK_ROWS) -> Step:
    """A session machine per client: connect, send, disconnect, and a second connect in between.

    Results ``sessions_finished``: each session in the epoch of its first disconnect.
    Carried: the latest session of every client, and the time of the last event. Events
    of a busy client are numbered in chunks; what is joined per client is one row for
    each session of the micro-batch.
    """

    def run(batch: DataFrame, before: Tables, keep: Keep) -> tuple[Tables, Tables]:
        known = batch.filter(F.col("client").isNotNull()).withColumn("_micros", F.unix_micros("event_time"))
        marker = F.struct(*order, is_action(CONNECTED).alias("open"))
        numbered = running_values(
            known,
            ["client"],
            list(order),
            {"session": _one_if(is_action(CONNECTED)), "closed": _one_if(is_action(DISCONNECTED))},
            {"latest": F.when(is_action(CONNECTED) | is_action(DISCONNECTED), marker)},
            chunk_rows,
        )
        # before its first connect here, a client may be in a session of an earlier epoch
        within = F.when(F.col("session") == 0, F.col("closed") == 0).otherwise(F.coalesce("latest.open", F.lit(False)))
        sent = is_action(SENT) & within
        grouped = keep(
            numbered.groupBy("client", "session").agg(
                F.min(F.when(is_action(CONNECTED), F.col("event_time"))).alias("connected_at"),
                F.min(F.when(is_action(DISCONNECTED), F.col("event_time"))).alias("disconnected_at"),
                F.max(F.when(sent, F.col("event_time"))).alias("last_sent_at"),
                F.count_if(sent).alias("sent"),
            ),
            "sessions",
        )
        last = before["clients"]
        here = grouped.filter(F.col("session") == 0).select(
            "client", *[F.col(c).alias(f"_{c}") for c in ("disconnected_at", "last_sent_at", "sent")]
        )
        was_open = F.col("disconnected_at").isNull()
        continued = last.join(here, "client", "left").select(
            "client",
            "session",
            "connected_at",
            F.coalesce("disconnected_at", "_disconnected_at").alias("disconnected_at"),
            F.when(was_open, F.greatest("last_sent_at", "_last_sent_at")).otherwise(F.col("last_sent_at")).alias("last_sent_at"),
            (F.col("sent") + F.when(was_open, F.coalesce("_sent", F.lit(0))).otherwise(0)).alias("sent"),
            (was_open & F.col("_disconnected_at").isNotNull()).alias("ended"),
        )
        numbers = last.select("client", F.col("session").alias("_before"))
        begun = grouped.filter(F.col("session") > 0).join(numbers, "client", "left")
        begun = begun.withColumn("session", F.col("session") + F.coalesce("_before", F.lit(0))).drop("_before")
        latest = keep(continued.unionByName(begun.withColumn("ended", F.col("disconnected_at").isNotNull())), "all-sessions")
        columns = ["session", "connected_at", "disconnected_at", "last_sent_at", "sent"]
        clients = latest.groupBy("client").agg(F.max_by(F.struct(*columns), F.col("session")).alias("s")).select("client", "s.*")
        now = before["session_clock"].unionByName(batch.agg(F.max("event_time").alias("now"))).agg(F.max("now").alias("now"))
        ended = latest.filter("ended").select("client", *columns)
        return {"sessions_finished": ended}, {"clients": clients, "session_clock": now}

    return Step({"clients": _SESSION, "session_clock": "now timestamp"}, run)


def finished_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Sends and seconds of every finished session, as ``delivery.session_durations``."""
    duration = seconds_between(F.col("connected_at"), F.col("disconnected_at"))
    return read_finished(spark, path, "sessions_finished").select("client", "session", "sent", duration.alias("duration_s"))


def client_stats(spark: SparkSession, path: str) -> DataFrame:
    """The open session of every connected client at the last event, as ``delivery.client_stats``."""
    now = read_carried(spark, path, "session_clock").agg(F.max("now").alias("now")).scalar()
    return read_carried(spark, path, "clients").filter(F.col("disconnected_at").isNull()).select(
        "client",
        "session",
        "sent",
        "connected_at",
        "last_sent_at",
        seconds_between(F.col("connected_at"), now).alias("connected_s"),
        F.lit("streaming").alias("status"),
    )


# -- rate at every send ---------------------------------------------------------------


def trailing_rate_step(
    window_s: int = RATE_WINDOW_S, cap: int | None = RATE_RING, lateness_s: int = 0, chunk_rows: int = CHUNK_ROWS
) -> Step:
    """At every send, the sends of the last ``window_s`` seconds.

    A send is rated when the watermark, the latest time seen less ``lateness_s``, has
    passed it: then all sends of its instant and window are there. Until then it is held.
    Sends that arrive after the watermark has passed them, or without a time, are results
    ``late_sends``; they count for sends that are not rated yet. Carried: held sends, the sends of the
    last window, and the watermark.
    """
    width = window_s * 1_000_000

    def run(batch: DataFrame, before: Tables, keep: Keep) -> tuple[Tables, Tables]:
        clock = before["rate_clock"].unionByName(
            batch.agg((F.max(F.unix_micros("event_time")) - lateness_s * 1_000_000).alias("mark"))
        )
        marks = clock.agg(F.max("mark").alias("mark")).first()["mark"]
        passed = before["rate_clock"].agg(F.max("mark").alias("mark")).first()["mark"]
        mark, passed = (-(2**62) if m is None else m for m in (marks, passed))
        sends = batch.filter(is_action(SENT)).select(*_COLUMNS).withColumn("_micros", F.unix_micros("event_time"))
        late = sends.filter(F.coalesce(F.col("_micros") < passed, F.lit(True)))
        waiting = before["held_sends"].withColumn("_micros", F.unix_micros("event_time")).unionByName(sends.filter(F.col("_micros") >= passed))
        earlier = before["window_sends"].unionByName(late.select("seq", "_micros"))
        waiting = keep(waiting, "waiting")
        ready = waiting.filter(F.col("_micros") < mark)
        counted = ready.withColumn("_rated", F.lit(True)).unionByName(earlier.withColumn("_rated", F.lit(False)), allowMissingColumns=True)
        rated = trailing_counts(counted, [], "_micros", ["seq"], width, "sends", chunk_rows).filter("_rated")
        window = earlier.unionByName(ready.select("seq", "_micros")).filter(F.col("_micros") > mark - width)
        return (
            {"rates": _capped(rated, cap).select(*_COLUMNS, "sends", "sends_capped"), "late_sends": late.drop("_micros")},
            {
                "held_sends": waiting.filter(F.col("_micros") >= mark).drop("_micros"),
                "window_sends": window,
                "rate_clock": batch.sparkSession.createDataFrame([(mark,)], "mark bigint"),
            },
        )

    return Step({"held_sends": _EVENT, "window_sends": "seq bigint, _micros bigint", "rate_clock": "mark bigint"}, run)


def _capped(rated: DataFrame, cap: int | None) -> DataFrame:
    capped = F.col("sends") if cap is None else F.least(F.col("sends"), F.lit(cap).cast("bigint"))
    return rated.withColumn("sends_capped", capped)


def trailing_rates(
    spark: SparkSession, path: str, window_s: int = RATE_WINDOW_S, cap: int | None = RATE_RING, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The rates of all sends so far, as ``delivery.trailing_rate``: the stored ones, and those of held sends as of now."""
    held = read_carried(spark, path, "held_sends").withColumn("_micros", F.unix_micros("event_time")).withColumn("_rated", F.lit(True))
    counted = held.unionByName(read_carried(spark, path, "window_sends").withColumn("_rated", F.lit(False)), allowMissingColumns=True)
    rated = trailing_counts(counted, [], "_micros", ["seq"], window_s * 1_000_000, "sends", chunk_rows).filter("_rated")
    return read_finished(spark, path, "rates").drop("epoch").unionByName(_capped(rated, cap).select(*_COLUMNS, "sends", "sends_capped"))


# -- latest connects and disconnects --------------------------------------------------


def history_step(n: int = HISTORY_SHOWN, keep_rows: int = HISTORY_RING, order: Sequence[str] = DEFAULT_ORDER) -> Step:
    """Results ``history``: after each trigger the latest ``n`` changes, ``place`` 1 the oldest. Carried: the latest ``keep_rows``."""

    def run(batch: DataFrame, before: Tables, keep: Keep) -> tuple[Tables, Tables]:
        changes = batch.filter(is_action(CONNECTED) | is_action(DISCONNECTED)).select(*_COLUMNS)
        both = before["changes"].unionByName(changes).withColumn("_micros", F.unix_micros("event_time"))
        latest = keep(both.orderBy(*[F.col(c).desc() for c in order]).limit(keep_rows).drop("_micros"), "changes")
        return {"history": delivery.shown_history(latest, min(n, keep_rows), order)}, {"changes": latest}

    return Step({"changes": _EVENT}, run)


def connection_history(spark: SparkSession, path: str) -> DataFrame:
    """The latest changes after the last trigger."""
    history = read_finished(spark, path, "history")
    return history.filter(F.col("epoch") == history.agg(F.max("epoch").alias("e")).scalar()).drop("epoch")


# -- status ---------------------------------------------------------------------------


_TOTALS = (
    "total_sent bigint, active_connections bigint, total_connections bigint, errors bigint, first_at timestamp, last_at timestamp"
)


def snapshot_step(messages: DataFrame) -> Step:
    """Results ``snapshot``: one row per trigger with the numbers of the dashboard, as of the latest event.

    Carried: totals, which add up, and the sends of the last minute by instant.
    """
    available = messages.agg(F.count(F.lit(1)).alias("n")).first()["n"]

    def run(batch: DataFrame, before: Tables, keep: Keep) -> tuple[Tables, Tables]:
        step = F.when(is_action(CONNECTED), 1).when(is_action(DISCONNECTED), -1).otherwise(0).cast("bigint")
        here = batch.agg(
            F.count_if(is_action(SENT)).alias("total_sent"),
            F.sum(step).alias("active_connections"),
            F.count_if(is_action(CONNECTED)).alias("total_connections"),
            F.count_if(is_action(ERROR)).alias("errors"),
            F.min("event_time").alias("first_at"),
            F.max("event_time").alias("last_at"),
        )
        counts = ["total_sent", "active_connections", "total_connections", "errors"]
        totals = keep(
            before["totals"].unionByName(here).agg(
                *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
                F.min("first_at").alias("first_at"),
                F.max("last_at").alias("last_at"),
            ),
            "totals",
        )
        minute_ago = F.unix_micros(totals.select("last_at").scalar()) - RATE_WINDOW_S * 1_000_000
        sends = batch.filter(is_action(SENT)).groupBy(F.unix_micros("event_time").alias("micros")).agg(F.count(F.lit(1)).alias("sends"))
        recent = before["minute"].unionByName(sends).filter(F.col("micros") > minute_ago)
        recent = keep(recent.groupBy("micros").agg(F.sum("sends").alias("sends")), "minute")
        timed = totals.withColumns(
            {
                "_recent": F.coalesce(recent.agg(F.sum("sends").alias("n")).scalar(), F.lit(0)),
                "uptime_s": F.coalesce(seconds_between(F.col("first_at"), F.col("last_at")), F.lit(0.0)),
                "available": F.lit(available).cast("bigint"),
            }
        )
        return {"snapshot": timed.select(F.col("last_at").alias("at"), *delivery.dashboard())}, {"totals": totals, "minute": recent}

    return Step({"totals": _TOTALS, "minute": "micros bigint, sends bigint"}, run)


def status_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The row of the last trigger, as ``delivery.status_snapshot``."""
    rows = read_finished(spark, path, "snapshot")
    return rows.filter(F.col("epoch") == rows.agg(F.max("epoch").alias("e")).scalar()).drop("epoch", "at")
