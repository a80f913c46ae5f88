"""Streams that carry small tables from one micro-batch to the next, and readers of finished epochs.

A step turns a micro-batch, and what the epoch before carried, into result tables and
into what the next epoch gets. Under ``path`` an epoch N writes

    <table>/epoch-N            results, with the column ``epoch``
    _carried/<table>/epoch-N   what epoch N + 1 reads
    _work/epoch-N              tables that the step keeps while it runs
    _finished/epoch-N          an empty file, made last

Readers only take epochs with that file, so they never see one half written. A
micro-batch that runs again after a failure reads the same carried tables and overwrites
its folders. Carried tables that no epoch can read any more are removed, and ``compact``
brings the results of finished epochs together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodline.streaming.feed import trigger_of

Keep = Callable[[DataFrame, str], DataFrame]
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """``carried`` names the carried tables with their schemas as DDL; they are empty before the first epoch.

    ``run`` takes the micro-batch, the carried tables and a function that writes a table
    once for the time of the epoch; it returns results and carried tables by name.
    """

    carried: Mapping[str, str]
    run: Callable[[DataFrame, Tables, Keep], tuple[Tables, Tables]]


def combined(*steps: Step) -> Step:
    """Several steps over the same micro-batches. Their tables have different names."""

    def run(batch: DataFrame, before: Tables, keep: Keep) -> tuple[Tables, Tables]:
        results, carried = {}, {}
        for step in steps:
            r, c = step.run(batch, {name: before[name] for name in step.carried}, keep)
            results.update(r)
            carried.update(c)
        return results, carried

    names = [name for step in steps for name in step.carried]
    if len(set(names)) < len(names):
        raise ValueError(f"carried tables share names: {sorted(names)}")
    return Step({name: ddl for step in steps for name, ddl in step.carried.items()}, run)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _remove(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    if fs.exists(place):
        fs.delete(place, True)


def _mark(spark: SparkSession, path: str, name: str) -> None:
    fs, place = _place(spark, f"{path}/_finished/{name}")
    fs.create(place, True).close()


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    found = (re.fullmatch(rf"{kind}-(\d+)", name) for name in _names(spark, f"{path}/_finished"))
    return sorted(int(m[1]) for m in found if m)


def start_epochs(stream: DataFrame, step: Step, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``step`` on every micro-batch. A path that holds the results of another checkpoint is refused."""
    spark = stream.sparkSession
    if _names(spark, path) and not _names(spark, checkpoint):
        raise FileExistsError(f"{path} holds results of another checkpoint")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession

        def keep(df: DataFrame, name: str) -> DataFrame:
            place = f"{path}/_work/epoch-{epoch}/{name}"
            df.write.mode("overwrite").parquet(place)
            return spark.read.schema(df.schema).parquet(place)

        before = {
            name: spark.read.schema(ddl).parquet(f"{path}/_carried/{name}/epoch-{epoch - 1}") if epoch else spark.createDataFrame([], ddl)
            for name, ddl in step.carried.items()
        }
        _remove(spark, f"{path}/_finished/epoch-{epoch}")
        results, carried = step.run(keep(batch, "arrived"), before, keep)
        for name, df in results.items():
            df.withColumn("epoch", F.lit(epoch).cast("bigint")).write.mode("overwrite").parquet(f"{path}/{name}/epoch-{epoch}")
        for name in step.carried:
            carried[name].write.mode("overwrite").parquet(f"{path}/_carried/{name}/epoch-{epoch}")
        _mark(spark, path, f"epoch-{epoch}")
        _remove(spark, f"{path}/_work/epoch-{epoch}")
        # This epoch may run again, and reads what the one before carried; that one cannot.
        for name in step.carried:
            _remove(spark, f"{path}/_carried/{name}/epoch-{epoch - 2}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger_of(every)).start()


def finished_epochs(spark: SparkSession, path: str) -> list[int]:
    """The epochs that readers see, in order. Those that ``compact`` has brought together count up to its last."""
    through = max(_numbers(spark, path, "through"), default=-1)
    return [*range(through + 1), *(n for n in _numbers(spark, path, "epoch") if n > through)]


def read_finished(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows of a result table of all finished epochs, with the column ``epoch``."""
    through = max(_numbers(spark, path, "through"), default=-1)
    folders = [f"{path}/{table}/epoch-{n}" for n in _numbers(spark, path, "epoch") if n > through]
    folders += [f"{path}/{table}/through-{through}"] if through >= 0 else []
    if not folders:
        raise FileNotFoundError(f"{path} has no finished epoch")
    return spark.read.parquet(*folders)


def read_carried(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A carried table as of the last finished epoch."""
    return spark.read.parquet(f"{path}/_carried/{table}/epoch-{finished_epochs(spark, path)[-1]}")


def compact(spark: SparkSession, path: str) -> int:
    """Bring the results of all finished epochs together, table by table; returns the last of them.

    Readers change over when all tables are written. Folders of single epochs stay until
    ``remove_compacted``, for readers that have begun on them.
    """
    last = finished_epochs(spark, path)[-1]
    for table in _names(spark, path):
        if not table.startswith("_"):
            read_finished(spark, path, table).write.mode("overwrite").parquet(f"{path}/{table}/through-{last}")
    _mark(spark, path, f"through-{last}")
    return last


def remove_compacted(spark: SparkSession, path: str) -> None:
    """Remove the folders that the latest ``compact`` has replaced."""
    through = max(_numbers(spark, path, "through"), default=-1)
    for table in [n for n in _names(spark, path) if not n.startswith("_")]:
        for name in _names(spark, f"{path}/{table}"):
            kind, _, number = name.rpartition("-")
            if number.isdigit() and (int(number) < through or (kind == "epoch" and int(number) == through)):
                _remove(spark, f"{path}/{table}/{name}")
