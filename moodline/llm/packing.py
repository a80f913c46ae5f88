"""Packing token pieces into sequences by exact complements, then best fit (operator 10).

Lengths are at most CAPACITY, so the plan works on the number of pieces of each length
and is as small for any table. ``pack_counts`` takes, while pieces last, singles, pairs
and triples whose lengths sum to CAPACITY exactly, each combination as often as its
lengths are available. What is left is packed by best fit: a sequence opens with the
longest length left and takes the longest that still fits. A pattern is used as often
as its lengths last, so that each uses up a length and there are few patterns.

Pieces then find their places: a piece's rank among those of its length, counted in
salted groups so that a frequent length is never gathered, falls into the slots that
the patterns gave to this length. Only narrow rows are ranked; the token ids of a piece,
little-endian in four bytes each, come back to its place by a key that no other piece has.
``sequences`` and ``write_sequences`` give the training sequences.

Defined results: a NULL or empty text gives one piece, the end token alone; repeated
rows are packed as often as they appear; further columns do not matter.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm.tables import staged

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
END = 1
SALT_ROWS = 2_000
CACHE_WORDS = 1_200_000
LEARN_ROWS = 250
MARKS = b".,;:!?*#$%&"
_MARKS_TOGETHER = re.compile(rb"[^a-z0-9\x20\x09-\x0d][.,][\x20\n]")
CACHE_NAME = "moodline_token_ids"
VOCABULARY = "word_bpe_49k.json"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, key long, ids binary"
PLACED = "doc_id long, piece int, start long, length long, key long, sequence_id long, offset long"
# Pieces of one task that keys have room for.
TASK_PIECES = 1 << 40
Slots = tuple[tuple[int, int], ...]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class _Ids(dict):
    """Token ids of a run of non-blank bytes, as little-endian bytes; forgets all when full.

    No token spans white space, and no normalisation reaches across it, so that a text's
    ids are those of its runs one after another. The tokenizer also parts letters from a
    run of marks after them, so a word is encoded once for all marks that may follow.
    """

    def __init__(self, path: str | None) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())

    def learn(self, runs: set[bytes]) -> None:
        new = [r for r in runs if r not in self]
        if len(self) + 2 * len(new) > CACHE_WORDS:
            self.clear()
            new = list(runs)
        parts, whole = {}, []
        for run in new:
            core = run.rstrip(MARKS)
            if len(core) < len(run) and core.decode("utf-8", "replace").isalpha():
                parts[run] = core, run[len(core) :]
            else:
                whole.append(run)
        self._encode(whole)
        self._encode([p for p in {p for pair in parts.values() for p in pair} if p not in self])
        for run, (core, marks) in parts.items():
            self[run] = self[core] + self[marks]

    def _encode(self, runs: list[bytes]) -> None:
        tokens, rest = self.tokenizer.model.tokenize, []
        for run in runs:
            # Normalising and splitting leave a word of small ASCII letters as it is.
            if run.isalpha() and run.islower():
                self[run] = array("I", [t.id for t in tokens(run.decode())]).tobytes()
            else:
                rest.append(run)
        found = self.tokenizer.encode_batch_fast([r.decode("utf-8", "replace") for r in rest], add_special_tokens=False)
        for run, e in zip(rest, found):
            self[run] = array("I", e.ids).tobytes()


def _ids(path: str | None) -> _Ids:
    """The cache of this Python worker, kept from task to task outside this module, which travels anew with each."""
    kept = sys.modules.setdefault(CACHE_NAME, ModuleType(CACHE_NAME)).__dict__.setdefault("by_path", {})
    if path not in kept:
        kept[path] = _Ids(path)
    return kept[path]


def _runs(raw: bytes | None) -> list[bytes]:
    """The runs of a text, in small letters where that cannot change what the tokenizer makes of them.

    Marks that combine with letters (U+0300 to U+037F start with these bytes) and special
    tokens depend on the case.
    """
    if not raw:
        return []
    if b"\xcc" in raw or b"\xcd" in raw or b"<|" in raw:
        return raw.split()
    small = raw.lower()
    if not _MARKS_TOGETHER.search(small):
        # Stops and commas that follow a letter or digit are tokens of their own anyway.
        small = small.replace(b", ", b" , ").replace(b". ", b" . ").replace(b".\n", b" .\n")
    return small.split()


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every document: its ids and the end token, cut only beyond ``capacity``.

    ``path`` names the vocabulary file on every executor. ``key`` numbers the pieces of
    each task; it differs for all rows of a table that is written, not from run to run.
    """
    end = np.array([END], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(path)
        key = TaskContext.get().partitionId() * TASK_PIECES
        for batch in (b.slice(at, LEARN_ROWS) for b in batches for at in range(0, max(1, len(b)), LEARN_ROWS)):
            rows = []
            texts = [_runs(text.as_py()) for text in batch.column(1)]
            ids.learn(set().union(*texts))
            for doc, runs in zip(batch.column(0).to_pylist(), texts):
                whole = b"".join(map(ids.__getitem__, runs)) + end
                for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), key, part))
                    key += 1
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "key", "ids"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(cut, PIECES)


def _exact(have: dict[int, int], capacity: int) -> list[tuple[Slots, int]]:
    """Patterns of one, two and three lengths that fill a sequence exactly."""
    out = []

    def take(*lengths: int) -> None:
        need = {x: lengths.count(x) for x in lengths}
        times = min(have.get(x, 0) // n for x, n in need.items())
        if times > 0:
            out.append((tuple(sorted(need.items(), reverse=True)), times))
            for x, n in need.items():
                have[x] -= n * times

    take(capacity)
    for a in range(capacity - 1, (capacity - 1) // 2, -1):
        if have.get(a):
            take(a, capacity - a)
    # Sums of pairs are looked up by their complement: for a longest length, the gap it leaves.
    for a in sorted((x for x, n in have.items() if n), reverse=True):
        gap = capacity - a
        for b in range(min(a, gap - 1), (gap - 1) // 2, -1):
            if not have[a]:
                break
            if have.get(b) and have.get(gap - b):
                take(a, b, gap - b)
    return out


def _best_fit(have: dict[int, int], capacity: int) -> list[tuple[Slots, int]]:
    out = []
    left = sorted(x for x, n in have.items() if n)
    while left:
        gap, used = capacity, {}
        limit = len(left)
        while limit:
            limit = min(limit, bisect_right(left, gap))
            if not limit:
                break
            x = left[limit - 1]
            n = min(gap // x, have[x])
            used[x] = n
            gap -= n * x
            limit -= 1
        times = min(have[x] // n for x, n in used.items())
        out.append((tuple(sorted(used.items(), reverse=True)), times))
        for x, n in used.items():
            have[x] -= n * times
        left = [x for x in left if have[x]]
    return out


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Slots, int]]:
    """Patterns ((length, how many), …) with their number of sequences, using up ``counts``."""
    have = {x: n for x, n in counts.items() if n}
    return _exact(have, capacity) + _best_fit(have, capacity)


def _slots(patterns: list[tuple[Slots, int]]) -> dict[int, np.ndarray]:
    """Per length: rows of (first rank, first sequence, pieces per sequence, offset), by rank.

    At most capacity patterns, of at most 90 lengths each: bounded whatever the table.
    """
    given: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for slots, times in patterns:
        offset = 0
        for length, n in slots:
            out.setdefault(length, []).append((given.get(length, 0), sequence, n, offset))
            given[length] = given.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in out.items()}


def packed(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, sequence_id, offset, ids`` of pieces (as ``pieces`` gives them)."""
    spark = found.sparkSession
    found = staged(found, "pieces")
    totals = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(pack_counts(totals, capacity)))
    salts = spark.createDataFrame([(x, max(1, -(-n // SALT_ROWS))) for x, n in totals.items()], "length long, salts long")
    salted = found.drop("ids").join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts"))).drop("salts")
    per = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("length", "salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "key")
    ranked = salted.withColumn("within", F.row_number().over(within) - 1).join(before, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "key", (F.col("before") + F.col("within")).alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(part):
                    rows = table[int(length[part[0]])]
                    hit = rows[np.searchsorted(rows[:, 0], rank[part], side="right") - 1]
                    along = rank[part] - hit[:, 0]
                    sequence[part] = hit[:, 1] + along // hit[:, 2]
                    offset[part] = hit[:, 3] + along % hit[:, 2] * length[part]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(placed, PLACED).join(found.select("key", "ids"), "key").drop("key")


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every piece of ``docs`` with its place, its ``ids`` and their digest, ``ids_crc32``."""
    return packed(pieces(docs, path)).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset", "ids")


def sequences(rows: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the pieces of each sequence one after another, at most CAPACITY ids."""
    parts = rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit("").cast("binary"), lambda whole, p: F.concat(whole, p["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))


def write_sequences(rows: DataFrame, path: str) -> None:
    """The sequences as Parquet, in files that follow one another by ``sequence_id``."""
    sequences(rows).repartitionByRange("sequence_id").sortWithinPartitions("sequence_id").write.parquet(path)
