"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.session import new_shared_path

BLANKS = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs do not compute it again."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are not ASCII white space."""
    return F.array_remove(F.split(text, BLANKS), "")
