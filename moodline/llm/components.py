"""Connected components of an edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm.tables import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these. Needs ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node with an edge to another.

    Each round is written to the shared folder, so the lineage stays one round long. The
    rounds grow with the logarithm of the longest path.
    """
    ends = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    now = staged(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(*ends).distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if mark == state or not mark["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = mark
        now = staged(_small_star(_large_star(now).where("u != v")), "star")
