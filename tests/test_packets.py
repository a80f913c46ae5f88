"""Cleaning, wire form and receiving."""

import json

import pytest
from pyspark.sql import functions as F

from moodline.operators import messages, packets
from moodline.schemas import MESSAGE


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")


def message_rows(spark):
    metrics = (1, 2, 3, 4, 5, 6)
    rows = [
        ("1", "x" * 20, "t", "a", "en", metrics, []),
        ("2", "x" * 21, "t", "a", "en", metrics, []),
        ("3", "x" * 20 + "😊", "t", "a", "en", None, None),
        ("4", None, "t", "a", "en", metrics, []),
        ("5", "x" * 30, "t", "a", None, metrics, []),
        ("6", "x" * 30, "t", "a", "fr", metrics, []),
    ]
    return spark.createDataFrame(rows, MESSAGE)


def test_clean_messages_is_strict_about_length(spark):
    kept = messages.clean_messages(message_rows(spark))
    assert [r.id for r in kept.orderBy("id").collect()] == ["2", "3"]
    assert messages.select_packet_columns(kept).columns == ["id", "text", "created_at", "author_id", "public_metrics"]


def test_preview_always_adds_dots(spark):
    got = messages.preview(message_rows(spark).filter("id in ('1','2')"), ["id"], n=1, chars=3).collect()
    assert [tuple(r) for r in got] == [("1", "xxx...")]


def test_packets_keep_field_order_and_characters(spark):
    source = message_rows(spark).filter("id in ('2','3')").withColumns(
        {"client": F.lit("10.0.0.1:555"), "seq": F.lit(7), "stream_id": F.lit(12345)}
    )
    sent = packets.build_packets(source, stream_timestamp=F.lit("2025-01-01T00:00:00"), total_sent=F.lit(6))
    texts = [json.loads(r.value) for r in packets.encode_packets(sent.orderBy("id")).collect()]
    assert list(texts[0])[:8] == [
        "id", "text", "original_created_at", "author_id", "public_metrics", "stream_timestamp", "stream_id", "server_info",
    ]
    assert texts[0]["public_metrics"]["like_count"] == 1
    assert texts[1]["public_metrics"] == {}
    assert texts[1]["text"].endswith("😊")
    assert texts[0]["server_info"] == {
        "server_host": "localhost", "server_port": 9999, "active_clients": 0, "total_tweets_sent": 6,
        "server_uptime": 0.0, "client_ip": "10.0.0.1",
    }
    back = packets.drop_control(packets.parse_packets(packets.encode_packets(sent)))
    assert sorted(map(repr, back.select(sent.columns).collect())) == sorted(map(repr, sent.collect()))


@pytest.mark.parametrize(
    "line, verdict",
    [
        ('{"text":"a"}', "packet"),
        ('  {"text":"a"}\r', "packet"),
        ("\x1f {\"text\":\"a\"} ", "packet"),
        ('{"text":7}', "packet"),
        ('{"text":"a","stream_id":"not a number"}', "packet"),
        ("{}", "packet"),
        ('{"type":null,"text":"a"}', "control"),
        ('{"type":"anything","text":"a"}', "control"),
        ("{bad", "bad"),
        ("[1]", "bad"),
        ("5", "bad"),
        ("null", "bad"),
        ('"the type"', "bad"),
        ("{'text':'a'}", "bad"),
        ('{"text":"a"} tail', "bad"),
        ('{"text":"a"},{"text":"b"}', "bad"),
        ('{"text":"a"', "bad"),
    ],
)
def test_line_parser(spark, line, verdict):
    row = packets.decode_lines(lines(spark, line)).first()
    assert ("bad" if row.packet is None else "control" if row.is_control else "packet") == verdict


def test_blank_lines_are_no_lines(spark):
    report = packets.reject_report(lines(spark, "", "   ", "\t", " ", '{"text":"a"}', "{bad", '{"type":"x"}')).first()
    assert (report["lines"], report["bad_lines"], report["other_control_messages"], report["packets"]) == (3, 1, 1, 1)


def test_bad_field_is_null_and_row_stays(spark):
    row = packets.parse_packets(lines(spark, '{"id":"1","text":"a","stream_id":"x","public_metrics":5}')).first()
    assert (row.packet.id, row.packet.text, row.packet.stream_id) == ("1", "a", None)


def test_text_and_time_fallbacks(spark):
    got = packets.receive(
        lines(
            spark,
            '{"id":"0","clean_text":"c","text":"t","timestamp":"T","stream_timestamp":"S"}',
            '{"id":"1","clean_text":"","text":"t","timestamp":"","stream_timestamp":"S"}',
            '{"id":"2","clean_text":null,"text":"t"}',
            '{"id":"3","clean_text":"c"}',
            '{"id":"4","text":""}',
            '{"id":"5"}',
            '{"id":"6","text":"  "}',
        )
    )
    rows = {r.id: (r.text, r.original_text, r.timestamp) for r in got.collect()}
    assert rows == {
        "0": ("c", "t", "T"), "1": ("t", "t", "S"), "2": ("t", "t", None), "3": ("c", "", None), "6": ("  ", "  ", None),
    }


def test_arrival_comes_from_server_counters_when_missing(spark):
    row = packets.receive(
        lines(spark, '{"text":"t","server_info":{"client_ip":"10.0.0.9","total_tweets_sent":41}}')
    ).first()
    assert (row.client, row.seq) == ("10.0.0.9", 41)


def test_control_messages(spark):
    got = packets.control_messages(
        lines(spark, '{"type":"welcome","message":"hi","total_tweets_available":49}', '{"type":"welcome","message":"x"}')
    )
    assert [tuple(r)[1:] for r in got.orderBy("n").collect()] == [("welcome", "hi", "49"), ("welcome", "x", "unknown")]


def test_strip_is_linear(spark):
    import time

    from moodline.functions.text import strip

    long = "a" + " " * 1_000_000 + "b"
    df = spark.createDataFrame([(long,), ("\u3000\x1c\tx \u2003y\x85\xa0",), (None,), (" \n",)], "v string").select(strip(F.col("v")).alias("v"))
    df.collect()
    began = time.monotonic()
    assert [r.v for r in df.collect()] == [long, "x \u2003y", None, ""]
    assert time.monotonic() - began < 2


def test_missing_client_and_place_are_filled(spark):
    lines = ['{"text":"hi"}', '{"text":"hi","stream_timestamp":"1970-01-01T00:00:01"}', '{"text":"hi","seq":5,"client":"c"}']
    got = packets.receive(spark.createDataFrame([(v,) for v in lines], "value string")).select("client", "seq").collect()
    assert sorted((r.client, r.seq) for r in got) == [("c", 5), ("unknown", 0), ("unknown", 1_000_000)]
