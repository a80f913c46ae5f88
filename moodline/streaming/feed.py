"""Continuous receiving and scoring of packets.

Decoding is row-wise. Scoring runs within each micro-batch, as a batch: so a lexicon of
any size works, and the processing time of a row is its share of the micro-batch's.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodline.operators.ordered import stored
from moodline.operators.packets import receive, rejected_lines, result_rows
from moodline.operators.scoring import DEFAULT_WORDS, EMPHASIS, Words, score_messages


def score_lines(
    lines: DataFrame,
    lexicon: DataFrame,
    level: int = EMPHASIS,
    words: Words = DEFAULT_WORDS,
    processed_at: Column | None = None,
    processing_time: Column | None = None,
) -> DataFrame:
    """From wire lines to result rows, for a batch or a stream."""
    scored = score_messages(receive(lines), lexicon, "text", level, words)
    return result_rows(scored, processed_at, processing_time)


def trigger_of(every: str | None) -> dict:
    """Trigger arguments: run at an interval, or take what there is and stop."""
    return {"processingTime": every} if every else {"availableNow": True}


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write_by_epoch(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Write every micro-batch to its own folder, as Parquet.

    A micro-batch that is run again after a failure overwrites its folder, so results
    are neither lost nor doubled. A new checkpoint starts at epoch 0 again, and would
    overwrite what another run left: such a path is refused.
    """
    if _exists(stream.sparkSession, path) and not _exists(stream.sparkSession, f"{checkpoint}/metadata"):
        raise FileExistsError(f"{path} holds results of another checkpoint")

    def write(batch: DataFrame, epoch: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(every))
        .start()
    )


def start_scoring(
    lines: DataFrame,
    lexicon: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    level: int = EMPHASIS,
    words: Words = DEFAULT_WORDS,
    processed_at: Column | None = None,
    processing_time: Column | None = None,
) -> StreamingQuery:
    """Score a packet stream and store all its results.

    Without ``processing_time`` a row gets the time its micro-batch took to score,
    divided by the number of rows.
    """

    def score(batch: DataFrame) -> DataFrame:
        if processing_time is not None:
            return score_lines(batch, lexicon, level, words, processed_at, processing_time)
        began = time.monotonic()
        results = stored(score_lines(batch, lexicon, level, words, processed_at), "scored")
        each = (time.monotonic() - began) / max(1, results.count())
        return results.withColumn("processing_time", F.lit(each))

    return write_by_epoch(lines, path, checkpoint, every, transform=score)


def start_rejects(lines: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Store the lines of a packet stream that cannot be decoded."""
    return write_by_epoch(rejected_lines(lines), path, checkpoint, every)
