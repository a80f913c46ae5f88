"""Schemas of the tables and of the JSON wire format (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

_METRIC_NAMES = [
    "like_count",
    "bookmark_count",
    "reply_count",
    "quote_count",
    "retweet_count",
    "impression_count",
]

METRICS = T.StructType([T.StructField(name, T.LongType()) for name in _METRIC_NAMES])

ANNOTATIONS = T.ArrayType(
    T.StructType([T.StructField("domain", T.StringType()), T.StructField("entity", T.StringType())])
)

MESSAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("public_metrics", METRICS),
        T.StructField("context_annotations", ANNOTATIONS),
    ]
)

SERVER_INFO = T.StructType(
    [
        T.StructField("server_host", T.StringType()),
        T.StructField("server_port", T.IntegerType()),
        T.StructField("active_clients", T.IntegerType()),
        T.StructField("total_tweets_sent", T.LongType()),
        T.StructField("server_uptime", T.DoubleType()),
        T.StructField("client_ip", T.StringType()),
    ]
)

# ``client`` and ``seq`` give the arrival order that the wire format itself
# lacks; ``clean_text`` and ``timestamp`` are optional and read by the receiver.
PACKET = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("original_created_at", T.StringType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("public_metrics", METRICS),
        T.StructField("stream_timestamp", T.StringType()),
        T.StructField("stream_id", T.IntegerType()),
        T.StructField("server_info", SERVER_INFO),
        T.StructField("client", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("clean_text", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

DELIVERY_LOG = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("client", T.StringType()),
        T.StructField("action", T.StringType()),
    ]
)

LEXICON = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("valence_tenths", T.IntegerType()),
        T.StructField("polarity_thousandths", T.IntegerType()),
        T.StructField("subjectivity_thousandths", T.IntegerType()),
    ]
)

# Actions of the delivery log.
CONNECTED = "client_connected"
DISCONNECTED = "client_disconnected"
SENT = "tweet_sent"
ERROR = "error"
