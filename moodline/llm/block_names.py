"""Exact duplicates by deterministic block naming (operator 11).

Texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``.

1. Every text, in UTF-8 without these characters, is cut into blocks of BLOCK bytes, the
   last one shorter; an empty text is one empty block. Equal blocks that a task meets
   together become one row, with references to their documents kept apart, so that a
   block of very many copies is a few rows in the sort and its references are not sorted.
2. Blocks are range-partitioned and sorted; equal neighbours get the number of the first.
3. Adjacent names of a document are paired, the last of an odd number with nothing, and
   the distinct pairs are numbered in turn, until each document has one name. Documents
   leave at the level where they have one left, so ``(level, name)`` is the same for two
   documents only if all their blocks are: there is no fingerprint that could collide.
4. Of each identity the row with the most code points in the original text stays, then
   the smallest ``doc_id``.

Frequent pairs and large groups of copies are joined through ``hot.attached``. A level
moves integers only, and there are as many as the logarithm of the longest text.

Defined results: a NULL text counts as empty, and all empty texts are one group; texts of
any length are read whole; rows without ``doc_id`` are rows like others, kept only where
no row with a ``doc_id`` has as many code points; of rows alike in ``doc_id`` and code
points one stays, the first that a task numbered; further columns do not matter. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm.hot import attached
from moodline.llm.tables import staged
from moodline.session import new_shared_path

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1024
# Bytes of distinct blocks that a task holds before it writes them.
HELD = 16 << 20
TASK_ROWS = 1 << 33
BLANK = b" \t\n\x0b\x0c\r"
NOTHING = -1

_CUT = (
    "row long, doc_id long, n_chars long, text_sha256 string, "
    "local long, block binary, rows array<long>, places array<long>, counts array<long>"
)
_CUT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()] + [pa.list_(pa.int64())] * 3


def _cut(docs: DataFrame, row: str | None, block: int) -> DataFrame:
    """Rows of documents (``row`` … ``text_sha256``), and rows of blocks with the documents and places that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start = TaskContext.get().partitionId() * TASK_ROWS
        row, local = start, start
        facts, held, size = [], {}, 0

        def flushed() -> pa.RecordBatch:
            nonlocal local
            columns = [list(c) for c in zip(*facts)] or [[], [], [], []]
            n, m = len(facts), len(held)
            arrays = [c + [None] * m for c in columns]
            arrays.append([None] * n + list(range(local, local + m)))
            arrays.append([None] * n + list(held))
            arrays += [[None] * n + [list(refs[k]) for refs in held.values()] for k in range(3)]
            local += m
            return pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, _CUT_TYPES)], names=_NAMES)

        for batch in batches:
            for doc, own, chars, text in zip(*(batch.column(i) for i in range(4))):
                own = own.as_py()
                if own is None:
                    own, row = row, row + 1
                raw = (text.as_py() or b"").translate(None, BLANK)
                facts.append((own, doc.as_py(), chars.as_py() or 0, hashlib.sha256(raw).hexdigest()))
                count = max(1, -(-len(raw) // block))
                for place in range(count):
                    part = raw[place * block : (place + 1) * block]
                    refs = held.get(part)
                    if refs is None:
                        refs = held[part] = ([], [], [])
                        size += len(part) + 100
                    refs[0].append(own)
                    refs[1].append(place)
                    refs[2].append(count)
                size += 50
                if size > HELD:
                    yield flushed()
                    facts, held, size = [], {}, 0
        yield flushed()

    own = F.col(f"`{row}`").cast("long") if row else F.lit(None).cast("long")
    narrow = docs.select("doc_id", own.alias("row"), F.length("text").cast("long").alias("chars"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, _CUT)


_NAMES = [field.split(" ")[0] for field in _CUT.split(", ")]


def _numbered_pairs(pairs: DataFrame) -> DataFrame:
    """``a, b, size, name``: the distinct pairs in order, and how many rows have each."""
    distinct = pairs.groupBy("a", "b").agg(F.count("*").alias("size")).sortWithinPartitions("a", "b")
    return staged(distinct.withColumn("name", F.monotonically_increasing_id()), "pair-names")


def identities(docs: DataFrame, row: str | None = None, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, n_chars, text_sha256`` and its identity ``level, name``.

    ``row`` may name a column of integers, unlike in all rows and never NULL; without it
    tasks number their rows.
    """
    path = new_shared_path(docs.sparkSession, "blocks")
    _cut(docs, row, block).write.option("compression", "zstd").parquet(path)
    cut = docs.sparkSession.read.schema(_CUT).parquet(path)

    ordered = cut.where("local IS NOT NULL").select("local", "block").repartitionByRange("block").sortWithinPartitions("block")
    at = ordered.withColumn("at", F.monotonically_increasing_id())
    named = at.select("local", F.min("at").over(Window.partitionBy("block")).alias("name"))
    refs = cut.where("local IS NOT NULL").select("local", F.arrays_zip("rows", "places", "counts").alias("refs"))
    held = named.join(refs, "local").select("name", F.explode("refs").alias("r"))
    now = staged(held.select(F.col("r.rows").alias("row"), F.col("r.places").alias("place"), F.col("r.counts").alias("count"), "name"), "names")

    done = now.where("count = 1").select("row", F.lit(0).alias("level"), "name")
    longest = now.agg(F.max("count").alias("n")).first()["n"] or 1
    for level in range(1, math.ceil(math.log2(longest)) + 1):
        left = F.max(F.when(F.col("place") % 2 == 0, F.col("name")))
        right = F.max(F.when(F.col("place") % 2 == 1, F.col("name")))
        half = F.shiftright("place", 1).alias("place")
        paired = now.where("count > 1").groupBy("row", half, "count").agg(left.alias("a"), F.coalesce(right, F.lit(NOTHING)).alias("b"))
        pairs = staged(paired.withColumn("count", F.shiftright(F.col("count") + 1, 1)), "pairs")
        names = _numbered_pairs(pairs)
        total = names.agg(F.sum("size").alias("n")).first()["n"]
        now = staged(attached(pairs, names, ["a", "b"], "size", total).select("row", "place", "count", "name"), "names")
        done = done.union(now.where("count = 1").select("row", F.lit(level).alias("level"), "name"))
    facts = cut.where("row IS NOT NULL").select("row", "doc_id", "n_chars", "text_sha256")
    return facts.join(done, "row")


def groups(docs: DataFrame, row: str | None = None, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, keep_id, group_size, kept, text_sha256``."""
    members = staged(identities(docs, row, block), "identities")
    first = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row"))
    best = staged(members.groupBy("level", "name").agg(F.count("*").alias("group_size"), first.alias("first")), "groups")
    total = best.agg(F.sum("group_size").alias("n")).first()["n"] or 0
    out = attached(members, best, ["level", "name"], "group_size", total)
    return out.select(
        "row", "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256"
    )


def distinct_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts."""
    number = "row"
    while number in (c.lower() for c in docs.columns):
        number += "_"
    numbered = staged(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    kept = groups(numbered, number, block).where("kept").select(F.col("row").alias(number))
    return numbered.join(kept, number, "left_semi").drop(number)
