"""Mixing sources to target weights by a curriculum that changes over time (operator 7).

A source has a target, the words the mix takes from it, and a schedule, its relative
weight at a few times of training in [0, 1] with straight lines between. The integral
of the schedule, scaled to the target, is the source's cumulative demand. A document's
words lie one after another in its source's own order (a hash of its id); inverting
the demand at the place where a copy starts gives the copy's training position. The
mix is the copies sorted by position, a range sort.

Targets: sources in code point order, NULL last, weigh 1, 2, 3, repeating, and share
all words; a target stops at MAX_REPEATS times the source's size, and the excess is
shared among the others by weight until none is above. So a document is taken at most
MAX_REPEATS times; the last copy of a source that does not fit whole is cut.

Prefix sums never gather a source: documents fall into hash buckets of about
BUCKET_ROWS rows; a window runs within a bucket, and another over the bucket totals.

Defined results: a NULL or wordless text has size 0, is taken 0 times and has no
position; an empty table gives no rows; repeated rows count as often as they appear;
further columns do not matter. A rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm.tables import staged, words_of

MAX_REPEATS = 3
BUCKET_ROWS = 5000
SCHEDULE = ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0))
WEIGHTS = (1, 2, 3)


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep``, ``doc_id``, ``source``, ``size``, the number of words of the whole text, and ``place``, its order within the source."""
    size = F.coalesce(F.size(words_of(F.col("text"))), F.lit(0)).cast("long")
    return docs.select(*keep, "doc_id", "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("place"))


def _filled(sizes: list[int], weights: list[int]) -> list[float]:
    """Shares of the total by weight, none above MAX_REPEATS times its size."""
    total, targets = float(sum(sizes)), [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), total
    while open_ and left > 0:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / weight >= MAX_REPEATS * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = float(MAX_REPEATS * sizes[i])
        left = total - sum(targets[i] for i in range(len(sizes)) if i not in open_ or i in full)
        open_ -= full
    return targets


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: its size, target, number of buckets and kind of schedule.

    Only one row per source reaches the driver; sources are named, not counted by rows.
    """
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))]
    shares = _filled([r["source_size"] for r in found], weights)
    listed = [(r["source"], r["source_size"], float(t), max(1, -(-r["n"] // BUCKET_ROWS)), i % len(SCHEDULE)) for i, (r, t) in enumerate(zip(found, shares))]
    return rows.sparkSession.createDataFrame(listed, "source string, source_size long, target double, buckets long, kind int")


def _position(share: Column, kind: Column) -> Column:
    """Time at which a schedule has spent ``share`` of its demand: the inverse of its integral.

    On a piece from (t0, w0) to (t1, w1) the integral is quadratic in time; its root is
    written so that it also holds where the weight does not change.
    """
    out = F.lit(None).cast("double")
    for k, points in enumerate(SCHEDULE):
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:])]
        total, done, here = sum(areas), 0.0, F.lit(1.0)
        pieces = []
        for (t0, w0), (t1, w1), area in zip(points, points[1:], areas):
            pieces.append((t0, w0, (w1 - w0) / (t1 - t0), done, done + area))
            done += area
        for t0, w0, slope, start, end in reversed(pieces):
            need = share * total - start
            root = t0 + 2 * need / (w0 + F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * need)))
            here = F.when(share * total <= end, root).otherwise(here)
        out = F.when(kind == k, here).otherwise(out)
    return out


def plan(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row: ``keep``, doc_id, source, size, source_size, target, kind, start, taken, position.

    ``start`` is the number of the source's words before it, ``kind`` its source's
    schedule, ``position`` that of its first copy in [0, 1] of training, NULL if it is
    not taken.
    """
    narrow = staged(sized(docs), "sizes")
    named = targets(narrow)

    def bucketed(rows: DataFrame) -> DataFrame:
        # One row per source, made on the driver: as small as the list of sources.
        joined = rows.join(named, rows["source"].eqNullSafe(named["source"])).drop(named["source"])
        share = F.shiftrightunsigned("place", 11) / F.lit(float(1 << 53))
        return joined.withColumn("bucket", F.floor(share * F.col("buckets")))

    totals = bucketed(narrow).groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = bucketed(sized(docs, *keep) if keep else narrow).withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = inside.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    start = F.col("before") + F.col("inside")
    whole = F.floor(F.col("target")).cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = whole - rounds * F.col("source_size")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    out = placed.select(*keep, "doc_id", "source", "size", "source_size", "target", "kind", start.alias("start"), taken.cast("long").alias("taken"))
    return out.withColumn("position", F.when(F.col("taken") > 0, _position(F.col("start") / F.col("target"), F.col("kind"))))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: one row per copy taken, sorted by training position, with the columns of ``docs``.

    A copy that is cut keeps its first words, joined by single spaces.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    planned = plan(docs.select("doc_id", "source", "text", row.alias("row")), "row", "text").where("taken > 0")
    copies = planned.withColumn("copy", F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)))
    left = F.col("taken") - F.col("copy") * F.col("size")
    text = F.when(left >= F.col("size"), F.col("text")).otherwise(F.array_join(F.slice(words_of(F.col("text")), 1, left.cast("int")), " "))
    at = _position((F.col("start") + F.col("copy") * F.col("source_size")) / F.col("target"), F.col("kind"))
    out = copies.select("row", text.alias("text"), at.alias("at"), "doc_id", "copy").orderBy("at", "doc_id", "copy")
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
