"""The wire form: building, encoding and decoding of message packets.

All functions are row-wise and work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.labels import label_compound, label_polarity
from moodline.functions.report import iso_text
from moodline.functions.text import non_empty, once, strip
from moodline.schemas import METRICS, PACKET

_DECODE_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
_CONTROL_KEY = "type"
UNKNOWN = "unknown"


def build_packets(
    messages: DataFrame,
    *,
    server_host: str = "localhost",
    server_port: int = 9999,
    client: Column | str = "client",
    seq: Column | str = "seq",
    stream_id: Column | str = "stream_id",
    stream_timestamp: Column | None = None,
    active_clients: Column | None = None,
    total_sent: Column | None = None,
    uptime: Column | None = None,
) -> DataFrame:
    """Wrap messages in packets.

    ``client`` is the ``ip:port`` of the receiver; ``total_sent`` is the number of
    sends *before* the packet. Counters default to none sent and nobody there.
    """
    client = F.col(client) if isinstance(client, str) else client
    seq = F.col(seq) if isinstance(seq, str) else seq
    stream_id = F.col(stream_id) if isinstance(stream_id, str) else stream_id
    zero = F.lit(0).cast("bigint")
    metrics = F.struct(*[F.col("public_metrics")[f.name].alias(f.name) for f in METRICS.fields])
    info = F.struct(
        F.lit(server_host).alias("server_host"),
        F.lit(server_port).cast("int").alias("server_port"),
        (zero if active_clients is None else active_clients).cast("int").alias("active_clients"),
        (zero if total_sent is None else total_sent).cast("bigint").alias("total_tweets_sent"),
        (F.lit(0.0) if uptime is None else uptime).cast("double").alias("server_uptime"),
        F.substring_index(client, ":", 1).alias("client_ip"),
    )
    return messages.select(
        "id",
        "text",
        F.col("created_at").alias("original_created_at"),
        "author_id",
        metrics.alias("public_metrics"),
        (iso_text(F.current_timestamp()) if stream_timestamp is None else stream_timestamp).alias(
            "stream_timestamp"
        ),
        stream_id.cast("int").alias("stream_id"),
        info.alias("server_info"),
        client.alias("client"),
        seq.cast("bigint").alias("seq"),
    )


def _metrics_map() -> Column:
    """Metrics as a map, so that missing metrics are written as an empty object."""
    names = [f.name for f in METRICS.fields]
    pairs = [x for name in names for x in (F.lit(name), F.col("public_metrics")[name])]
    known = F.coalesce(*[F.col("public_metrics")[name] for name in names]).isNotNull()
    nothing = F.create_map().cast("map<string,bigint>")
    return F.when(known, F.create_map(*pairs)).otherwise(nothing)


def encode_packets(packets: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON text per packet, null fields kept and non-ASCII characters as they are.

    Columns named in ``keep`` stay beside the text.
    """
    fields = [
        _metrics_map().alias(name) if name == "public_metrics" else F.col(name) for name in packets.columns
    ]
    return packets.select(*keep, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def decode_lines(lines: DataFrame) -> DataFrame:
    """Decode ``value``: add ``packet`` (NULL for a bad line) and ``is_control``.

    Blank lines go. The line is decoded as the one element of an array, so that
    anything behind the object, or a bare value, makes the line bad; a field of
    the wrong type is only NULL. A control line is any object that *has* the key
    ``type``, whatever its value.
    """

    def decode(line: Column) -> Column:
        wrapped = F.concat(F.lit("["), line, F.lit("]"))
        return F.struct(
            line.alias("line"),
            F.from_json(wrapped, f"array<{PACKET.simpleString()}>", _DECODE_OPTIONS).alias("items"),
            F.json_object_keys(line).alias("keys"),
        )

    others = [c for c in lines.columns if c != "value"]
    return (
        lines.select(*others, once(strip(F.col("value")), decode).alias("_decoded"))
        .filter(F.col("_decoded.line") != "")
        .select(
            *others,
            F.col("_decoded.line").alias("value"),
            F.when(F.size("_decoded.items") == 1, F.get("_decoded.items", F.lit(0))).alias("packet"),
            F.coalesce(F.array_contains("_decoded.keys", _CONTROL_KEY), F.lit(False)).alias("is_control"),
        )
    )


def _is_bad() -> Column:
    return F.col("packet").isNull()


def parse_packets(lines: DataFrame) -> DataFrame:
    """The well-formed objects among the lines, control messages included."""
    return decode_lines(lines).filter(~_is_bad())


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines that are not one JSON object."""
    return decode_lines(lines).filter(_is_bad()).drop("packet", "is_control")


def drop_control(parsed: DataFrame) -> DataFrame:
    """Flatten the packets and leave the control messages out."""
    extra = [c for c in parsed.columns if c not in ("value", "packet", "is_control", *PACKET.names)]
    return with_arrival(parsed.filter(~F.col("is_control")).select(*extra, "packet.*"))


def with_arrival(packets: DataFrame) -> DataFrame:
    """Fill ``client`` and ``seq`` where a packet lacks them, so that both are always known.

    The client is the server's address for it, else UNKNOWN. The place is the server's
    counter, else the packet's time in microseconds, else 0: such packets come first.
    """
    sent_at = F.unix_micros(F.try_to_timestamp("stream_timestamp"))
    return packets.withColumn("client", F.coalesce("client", F.col("server_info.client_ip"), F.lit(UNKNOWN))).withColumn(
        "seq", F.coalesce("seq", F.col("server_info.total_tweets_sent"), sent_at, F.lit(0))
    )


def control_messages(lines: DataFrame) -> DataFrame:
    """Type and numbers of the control messages."""
    control = decode_lines(lines).filter(~_is_bad() & F.col("is_control"))

    def read(path: str) -> Column:
        return F.get_json_object("value", path)

    return control.select(
        *[c for c in control.columns if c not in ("value", "packet", "is_control")],
        read("$.type").alias("type"),
        read("$.message").alias("message"),
        F.coalesce(read("$.total_tweets_available"), F.lit("unknown")).alias("total_tweets_available"),
    )


def reject_report(lines: DataFrame) -> DataFrame:
    """One row: how many lines were bad, control messages by type, and packets."""
    kind = F.get_json_object("value", "$.type")
    good_control = ~_is_bad() & F.col("is_control")
    known = F.coalesce(kind.isin("welcome", "completion"), F.lit(False))
    return decode_lines(lines).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(_is_bad()).alias("bad_lines"),
        F.count_if(good_control & (kind == "welcome")).alias("welcome_messages"),
        F.count_if(good_control & (kind == "completion")).alias("completion_messages"),
        F.count_if(good_control & ~known).alias("other_control_messages"),
        F.count_if(~_is_bad() & ~F.col("is_control")).alias("packets"),
    )


def pick_text(packets: DataFrame) -> DataFrame:
    """Choose text and time by fallback, and drop packets without text.

    ``original_text`` keeps the packet's own text, ``''`` where it has none.
    """
    chosen = F.coalesce(non_empty(F.col("clean_text")), non_empty(F.col("text")))
    return (
        packets.withColumn("original_text", F.coalesce("text", F.lit("")))
        .withColumn("text", chosen)
        .filter(F.col("text").isNotNull())
        .withColumn("timestamp", F.coalesce(non_empty(F.col("timestamp")), "stream_timestamp"))
        .drop("clean_text")
    )


def receive(lines: DataFrame) -> DataFrame:
    """From raw lines to the packets to be scored."""
    return pick_text(drop_control(parse_packets(lines)))


def result_rows(
    scored: DataFrame, processed_at: Column | None = None, processing_time: Column | None = None
) -> DataFrame:
    """The 15 result columns, after ``client`` and ``seq``.

    A time per row has no meaning inside a Spark task: give the share of a batch's
    duration as ``processing_time``, else it is NULL.
    """
    seconds = F.lit(None) if processing_time is None else processing_time
    return scored.select(
        "client",
        "seq",
        F.col("id").alias("tweet_id"),
        "stream_id",
        "text",
        "original_text",
        "timestamp",
        (iso_text(F.current_timestamp()) if processed_at is None else processed_at).alias("processed_at"),
        F.col("polarity").alias("polarity_score"),
        F.col("subjectivity").alias("polarity_subjectivity"),
        label_polarity(F.col("polarity")).alias("polarity_sentiment"),
        F.col("compound").alias("compound_score"),
        F.col("positive").alias("compound_positive"),
        F.col("negative").alias("compound_negative"),
        F.col("neutral").alias("compound_neutral"),
        label_compound(F.col("compound")).alias("compound_sentiment"),
        seconds.cast("double").alias("processing_time"),
    )
