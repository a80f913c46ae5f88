"""File sources and sinks: JSON lines, text lines and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.operators.batches import full_batches
from moodline.schemas import MESSAGE

# Only "\n" ends a line on the wire; Spark would also break at "\r".
_LINE_END = "\n"
_CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Stored messages from a folder of JSON lines. A missing folder is an error."""
    return spark.read.schema(MESSAGE).json(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Stored messages as JSON lines."""
    messages.select(*MESSAGE.names).write.json(path)


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """Wire lines as ``value``."""
    return spark.read.option("lineSep", _LINE_END).text(path)


def stream_packets(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Wire lines as they arrive in a folder; ``max_files`` bounds a micro-batch."""
    return (
        spark.readStream.schema("value string")
        .option("lineSep", _LINE_END)
        .option("maxFilesPerTrigger", max_files)
        .text(path)
    )


def write_packets(encoded: DataFrame, path: str, mode: str = "error") -> None:
    """Encoded packets, one JSON text per line."""
    encoded.select("value").write.mode(mode).option("lineSep", _LINE_END).text(path)


def write_results_json(results: DataFrame, path: str, mode: str = "error") -> None:
    """All results as JSON lines, null fields kept."""
    results.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_results_csv(results: DataFrame, path: str, mode: str = "error") -> None:
    """All results as CSV with a header. Empty strings and NULL look the same in CSV.

    Texts keep the white space at their ends, which Spark would strip.
    """
    results.write.mode(mode).options(header=True, quoteAll=True, **_CSV).csv(path)


def read_results_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Results written by ``write_results_csv``; texts may hold line ends."""
    return spark.read.schema(schema).options(header=True, multiLine=True, **_CSV).csv(path)


def write_full_batches(results: DataFrame, path: str, mode: str = "error") -> None:
    """Complete batches only, as JSON lines that carry ``client`` and ``batch_id``.

    Rows of a batch are already together. There is no folder per batch number: a busy
    client would make one for every ten messages.
    """
    full_batches(results).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_batch_ranges(results: DataFrame, path: str, batches_per_folder: int = 1000) -> None:
    """Complete batches in a folder for each range of batch numbers (``batch_range``).

    Writing again replaces the folders that ``results`` has batches for and no others, so
    a rerun over some clients' later results does not need the earlier ones. Readers that
    filter by ``batch_range`` read its folders only.
    """
    wide = full_batches(results)
    folder = F.call_function("div", F.col("batch_id") - 1, F.lit(batches_per_folder).cast("bigint"))
    options = {"partitionOverwriteMode": "dynamic", "ignoreNullFields": False}
    wide.withColumn("batch_range", folder).write.mode("overwrite").options(**options).partitionBy("batch_range").json(path)
