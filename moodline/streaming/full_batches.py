"""The rows of every full batch, as a stream completes them.

Rows are numbered inside each micro-batch with the batch operators, which split a busy
client. What is carried from one micro-batch to the next is written beside the output:
the rows of each client's open batch (fewer than ten) and how many batches it has
completed. Both are read from the folder of the epoch before, so an epoch that runs
again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from moodline.operators.batches import BATCH_SIZE
from moodline.operators.ordered import running_values, stored
from moodline.streaming.feed import trigger_of

_ROWS, _OPEN, _DONE = "rows", "open", "done"


def start_full_batches(
    results: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    keys: Sequence[str] = ("client",),
    order: Sequence[str] = ("seq",),
    size: int = BATCH_SIZE,
) -> StreamingQuery:
    """Write the rows of full batches with their ``batch_id``; rows arrive by micro-batch, then by ``order``."""
    schema = results.schema

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn("_fresh", F.lit(1))
        rows, done = fresh, None
        if epoch:
            kept = spark.read.schema(schema).parquet(f"{path}/{_OPEN}/epoch={epoch - 1}")
            rows = fresh.unionByName(kept.withColumn("_fresh", F.lit(0)))
            done = spark.read.schema(_done_schema(schema, keys)).parquet(f"{path}/{_DONE}/epoch={epoch - 1}")
        numbered = running_values(stored(rows, "arrived"), list(keys), ["_fresh", *order], {"_arrival": F.lit(1).cast("bigint")})
        numbered = stored(numbered, "numbered")
        counts = numbered.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        if done is not None:
            counts = counts.join(done, list(keys), "full")
        before = F.coalesce(F.col("done"), F.lit(0)) if done is not None else F.lit(0)
        full = F.floor(F.coalesce(F.col("_n"), F.lit(0)) / size)
        counts = stored(counts.select(*keys, before.cast("bigint").alias("_before"), full.alias("_full")), "counts")
        placed = numbered.join(counts, list(keys)).withColumn("_in", F.floor((F.col("_arrival") - 1) / size) + 1)
        batch_id = (F.col("_before") + F.col("_in")).cast("bigint")
        complete = placed.filter(F.col("_in") <= F.col("_full")).select(*schema.names, batch_id.alias("batch_id"))
        complete.write.mode("overwrite").parquet(f"{path}/{_ROWS}/epoch={epoch}")
        placed.filter(F.col("_in") > F.col("_full")).select(*schema.names).write.mode("overwrite").parquet(f"{path}/{_OPEN}/epoch={epoch}")
        counts.select(*keys, (F.col("_before") + F.col("_full")).cast("bigint").alias("done")).write.mode("overwrite").parquet(f"{path}/{_DONE}/epoch={epoch}")

    return results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger_of(every)).start()


def _done_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    return T.StructType([*[schema[k] for k in keys], T.StructField("done", T.LongType())])


def read_full_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all full batches so far."""
    return spark.read.parquet(f"{path}/{_ROWS}").drop("epoch")


def read_all_batches(spark: SparkSession, path: str, keys: Sequence[str] = ("client",)) -> DataFrame:
    """Those rows and, as a client's last batch, the rows of the open one."""
    full = read_full_batches(spark, path)
    last = spark.read.parquet(f"{path}/{_DONE}").agg(F.max("epoch")).first()[0]
    done = spark.read.parquet(f"{path}/{_DONE}/epoch={last}")
    waiting = spark.read.parquet(f"{path}/{_OPEN}/epoch={last}").join(done, list(keys))
    return full.unionByName(waiting.withColumn("batch_id", F.col("done") + 1).drop("done"))
