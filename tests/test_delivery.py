"""Delivery-log analytics on hand-made logs."""

from datetime import datetime, timedelta

import pytest

from moodline.operators import delivery, sampling
from moodline.schemas import CONNECTED, DISCONNECTED, ERROR, SENT

START = datetime(2025, 1, 1)
NAMES = {"c": CONNECTED, "d": DISCONNECTED, "s": SENT, "e": ERROR}


def log(spark, *events):
    """Events as (seconds, client, letter of the action)."""
    rows = [(i, START + timedelta(seconds=t), client, NAMES[a]) for i, (t, client, a) in enumerate(events)]
    return spark.createDataFrame(rows, "seq bigint, event_time timestamp, client string, action string")


def test_rate_leaves_out_an_event_exactly_a_minute_old(spark):
    events = log(spark, (0, "a", "s"), (0.000001, "a", "s"), (60, "a", "s"), (60.000001, "b", "s"), (60.5, "a", "e"))
    got = delivery.trailing_rate(events).orderBy("seq").collect()
    assert [r.sends for r in got] == [1, 2, 2, 2]
    by_client = delivery.rate_by_client(events).orderBy("seq").collect()
    assert [r.sends for r in by_client] == [1, 2, 2, 1]


@pytest.mark.parametrize("chunk_rows", [20, 10_000])
def test_rate_is_capped_by_its_history(spark, chunk_rows):
    events = log(spark, *[(i * 0.5, "a", "s") for i in range(70)])
    last = delivery.trailing_rate(events, chunk_rows=chunk_rows).orderBy("seq").collect()[-1]
    assert (last.sends, last.sends_capped) == (70, 60)


SESSIONS = [
    (0, "a", "d"), (1, "a", "s"),  # not in a session
    (2, "a", "c"), (3, "a", "s"), (4, "a", "s"), (5, "a", "d"), (6, "a", "s"),  # finished; one send too late
    (7, "a", "c"), (8, "a", "s"), (9, "a", "c"),  # replaced by a second connect, still open
    (3, "b", "c"), (4, "b", "s"), (10, "b", "d"), (11, "b", "d"),
    (12, None, "e"),
]


@pytest.mark.parametrize("chunk_rows", [3, 10_000])
def test_sessions(spark, chunk_rows):
    events = log(spark, *sorted(SESSIONS, key=lambda e: e[0]))
    done = delivery.session_durations(events, chunk_rows=chunk_rows).orderBy("client", "session")
    assert [tuple(r) for r in done.collect()] == [("a", 1, 2, 3.0), ("b", 1, 1, 7.0)]
    opened = delivery.client_stats(events, chunk_rows=chunk_rows).collect()
    assert [(r.client, r.session, r.sent, r.connected_s, r.last_sent_at, r.status) for r in opened] == [
        ("a", 3, 0, 3.0, None, "streaming")
    ]
    capped = delivery.session_cap(events, n=1, chunk_rows=chunk_rows).orderBy("client", "session")
    assert [(r.client, r.session, r.delivery) for r in capped.collect()] == [("a", 1, 1), ("a", 2, 1), ("b", 1, 1)]


@pytest.mark.parametrize("chunk_rows", [3, 10_000])
def test_counters_at_each_send(spark, chunk_rows):
    events = log(spark, (0, "a", "c"), (1, "a", "s"), (2, "b", "c"), (3, "b", "s"), (4, "a", "d"), (5, "b", "s"))
    got = delivery.packet_counters(events, chunk_rows=chunk_rows).orderBy("seq").collect()
    assert [(r.total_sent_before, r.active_clients) for r in got] == [(0, 1), (1, 2), (2, 1)]
    active = delivery.active_connections(events, chunk_rows=chunk_rows).orderBy("seq").collect()
    assert [r.active for r in active] == [1, 1, 2, 2, 1, 1]


def test_history_is_latest_first(spark):
    events = log(spark, (0, "10.0.0.1:5", "c"), (1, "x", "s"), (2, "y:1", "c"), (3, "10.0.0.1:5", "d"), (4, "y:1", "d"))
    got = [tuple(r) for r in delivery.connection_history(events).collect()]
    assert got == [
        ("00:00:04", "y", "disconnect"), ("00:00:03", "10.0.0.1", "disconnect"), ("00:00:02", "y", "connect"),
    ]


def test_rates_and_zero_uptime(spark):
    one = delivery.average_rate(log(spark, (5, "a", "s"))).first()
    assert (one.uptime_s, one.total_sent, one.average_rate, one.recent_average_rate) == (0.0, 1, None, 0.0)
    two = delivery.average_rate(log(spark, (0, "a", "s"), (30, "a", "s"))).first()
    assert (two.average_rate, two.recent_average_rate) == (4.0, 4.0)
    long = delivery.average_rate(log(spark, *[(i, "a", "s") for i in range(121)])).first()
    assert (long.average_rate, long.recent_average_rate) == (60.5, 60.0)


def test_status(spark):
    events = log(spark, (0, "a", "c"), (1, "a", "s"), (70, "a", "s"), (71, None, "e"))
    messages = spark.range(49)
    now = delivery.status_snapshot(events, messages).first()
    assert (now.uptime_s, now.total_sent, now.sends_per_minute, now.available) == (71.0, 2, 1, 49)
    assert (now.active_connections, now.total_connections, now.errors, now.status) == (1, 1, 1, "STREAMING")
    later = delivery.status_snapshot(events, messages, now=START + timedelta(seconds=131)).first()
    assert (later.sends_per_minute, later.uptime_s) == (0, 131.0)
    closed = delivery.status_snapshot(log(spark, (0, "a", "c"), (1, "a", "d")), messages).first()
    assert closed.status == "WAITING"


def test_empty_log(spark):
    nothing = log(spark, (0, "a", "s")).filter("false")
    assert delivery.log_totals(nothing).first().total_sent == 0
    assert delivery.status_snapshot(nothing, spark.range(0)).first().status == "WAITING"
    for operator in (delivery.active_connections, delivery.packet_counters, delivery.trailing_rate,
                     delivery.client_stats, delivery.session_durations, delivery.session_cap):
        assert operator(nothing).count() == 0


@pytest.mark.parametrize("chunk_rows", [4, 10_000])
def test_draws(spark, chunk_rows):
    messages = spark.range(17).selectExpr("cast(id as string) as id", "id as seq")
    sessions = spark.range(30).selectExpr("concat('c', id) as client")
    drawn = sampling.draw_with_replacement(messages, sessions, 50, 3, order=["seq"], chunk_rows=chunk_rows)
    rows = drawn.collect()
    assert len(rows) == 30 * 50
    assert {r.id for r in rows} == {str(i) for i in range(17)}
    assert all(10_000 <= r.stream_id <= 99_999 for r in rows)
    again = sampling.draw_with_replacement(messages.repartition(5), sessions, 50, 3, order=["seq"])
    assert sorted(map(repr, rows)) == sorted(map(repr, again.select(drawn.columns).collect()))
    other = sampling.draw_with_replacement(messages, sessions, 50, 4, order=["seq"])
    assert sorted(map(repr, rows)) != sorted(map(repr, other.select(drawn.columns).collect()))
    assert sampling.draw_with_replacement(messages.filter("false"), sessions, order=["seq"]).count() == 0
