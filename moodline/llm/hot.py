"""A join by key that a few very frequent keys cannot hold up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def attached(rows: DataFrame, table: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """Each row with the one row of ``table`` for its keys, which are never NULL.

    ``size`` says how many of the ``total`` rows a key has. Keys with more than a
    thousandth of them are fewer than a thousand, whatever the data: their rows of
    ``table`` are broadcast, and the others are shuffled. Both tables are read twice, so
    they should be written ones.
    """
    frequent = F.col(size) * SHARE > total
    hot = table.where(frequent)
    rest = rows.join(F.broadcast(hot.select(*keys)), list(keys), "left_anti")
    return rows.join(F.broadcast(hot), list(keys)).unionByName(rest.join(table.where(~frequent), list(keys)))
