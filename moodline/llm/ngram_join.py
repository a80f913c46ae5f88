"""N-gram Jaccard join with adaptive multi-match prefixes (operator 1).

A document is the set of its distinct word shingles, as 64-bit hashes. Two documents
link when 100 * intersection >= percent * union.

1. Equal sets become one class with the smallest ``doc_id`` as representative; the
   same pass counts shingles over all documents in a sketch of fixed size.
2. Every representative orders its shingles from rare to frequent by the sketch. Sets
   of n that link share at least ceil(t n), so they share l shingles among the first
   n - ceil(t n) + l of each. A document takes the l that makes its postings plus
   estimated candidates cheapest: the estimate, the sum of the counts in the prefix
   over l, falls as l grows where the prefix holds frequent shingles. Two documents
   need min(l, l') shared prefix shingles to become candidates, and more where their
   sizes say so: with an overlap of o to reach, at most the rest of one of them, n less
   its prefix, can lie behind the prefixes. The sketch only steers cost; any order and
   any l give all links.
3. Shingles that HOT documents or fewer hold in their prefixes give pairs, which are
   counted and verified on whole sets. Documents of a more frequent shingle are dealt
   into blocks of BLOCK, and each pair of blocks is one task that counts prefix
   matches, verifies on whole sets and hands on only a spanning forest of its links,
   so that no group is ever written out as pairs.
4. Links give components.

Defined results: NULL, empty and wordless texts have no shingle and link with nothing;
with fewer words than a shingle the whole sequence is the only one; rows that share a
``doc_id`` are one node; rows without ``doc_id`` take part only through equal sets;
further columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm.components import components
from moodline.llm.tables import staged

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SKETCH_BITS = 22
FILTER_BITS = 25
CHUNK = 1 << 16
MAX_MATCHES = 8
VERIFY_COST = 4.0
HOT = 64
BLOCK = 512
CACHE_WORDS = 150_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Eight-byte hashes of words; forgets all when full."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        digest = self[word] = xxhash.xxh3_64_digest(word)
        return digest


def shingle_set(raw: bytes | None, words: _Words, k: int) -> np.ndarray:
    """Sorted distinct shingles of a text in UTF-8."""
    found = raw.lower().split() if raw else []
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.frombuffer(b"".join(map(words.__getitem__, found)), dtype=np.uint64)
    width = min(k, len(h))
    n = len(h) - width + 1
    mixed = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        mixed = (mixed ^ h[j : j + n]) * _MIX
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def _first_pass(docs: DataFrame, k: int) -> DataFrame:
    """Rows of documents (``doc_id, n, sig``) and of partial sketches (``chunk, salt, counts``)."""
    partitions = docs.rdd.getNumPartitions()
    root = max(1, math.isqrt(partitions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, sketch = _Words(), np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            ns, sigs, held = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), words, k)
                ns.append(len(s))
                sigs.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                held.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                if len(held) >= 2000:
                    sketch += np.bincount(np.concatenate(held), minlength=1 << SKETCH_BITS).astype(np.uint32)
                    held = []
            if held:
                sketch += np.bincount(np.concatenate(held), minlength=1 << SKETCH_BITS).astype(np.uint32)
            none = pa.nulls(len(ns))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(sigs, pa.binary()), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())], _FIRST)
        salt = TaskContext.get().partitionId() % root
        for chunk, part in enumerate(np.split(sketch, len(sketch) // CHUNK)):
            if part.any():
                row = [[None], [None], [None], [chunk], [salt], [zlib.compress(part.tobytes(), 1)]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _FIRST_TYPES)], _FIRST)

    return _texts(docs).mapInArrow(run, "doc_id long, n long, sig binary, chunk int, salt int, counts binary")


_FIRST = ["doc_id", "n", "sig", "chunk", "salt", "counts"]
_FIRST_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]


def _combined(parts: DataFrame, size: int, combine: np.ufunc) -> np.ndarray:
    """Partial arrays of ``size`` numbers (``chunk, salt, counts``) as one, combined in two levels.

    The size is a constant, whatever the table.
    """

    def total(group: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(CHUNK, dtype=np.uint32)
        for part in group["counts"]:
            combine(out, np.frombuffer(zlib.decompress(part), dtype=np.uint32), out=out)
        return pd.DataFrame({"chunk": group["chunk"].iloc[:1], "counts": [zlib.compress(out.tobytes(), 1)]})

    schema = "chunk int, counts binary"
    halves = parts.groupBy("chunk", "salt").applyInPandas(total, schema)
    whole = np.zeros(size, dtype=np.uint32)
    for row in halves.groupBy("chunk").applyInPandas(total, schema).collect():
        whole[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.uint32)
    return whole


def _bit(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * _MIX) >> np.uint64(64 - FILTER_BITS)


def _filter(ids: DataFrame) -> np.ndarray:
    """2^FILTER_BITS bits in which the bits of all ids of a column are set: it lets few others pass."""
    root = max(1, math.isqrt(ids.rdd.getNumPartitions()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            bits[_bit(batch.column(0).to_numpy())] = True
        salt = TaskContext.get().partitionId() % root
        for chunk, part in enumerate(np.split(np.packbits(bits).view(np.uint32), max(1, (1 << FILTER_BITS) // 32 // CHUNK))):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([salt], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], ["chunk", "salt", "counts"])

    parts = ids.mapInArrow(run, "chunk int, salt int, counts binary")
    return _combined(parts, (1 << FILTER_BITS) // 32, np.bitwise_or)


def prefix(tokens: np.ndarray, counts: np.ndarray, load: float, percent: int) -> tuple[np.ndarray, int, int]:
    """Tokens from rare to frequent, the length of the prefix and the matches it requires."""
    n = len(tokens)
    order = np.lexsort((tokens, counts))
    share = -(-percent * n // 100)
    lengths = n - share + np.arange(1, min(MAX_MATCHES, share) + 1)
    excess = np.maximum(counts[order[: lengths[-1]]] - load - 3 * math.sqrt(load) - 1, 0)
    matches = np.arange(1, len(lengths) + 1)
    cost = lengths + VERIFY_COST * np.cumsum(excess)[lengths - 1] / matches
    best = int(np.argmin(cost))
    return tokens[order], int(lengths[best]), best + 1


def _prefixes(docs: DataFrame, k: int, percent: int, sketch, load: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = _Words(), sketch.value
        for batch in batches:
            ids, ns, ls, prefixes = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingle_set(text.as_py(), words, k)
                if len(s) and doc is not None:
                    ordered, p, l = prefix(s, table[s >> np.uint64(64 - SKETCH_BITS)].astype(np.int64), load, percent)
                    ids.append(doc)
                    ns.append(len(s))
                    ls.append(l)
                    prefixes.append(ordered[:p].view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)], dtype=np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(ls, pa.int32()), lists], ["doc_id", "n", "l", "tokens"])

    return _texts(docs).mapInArrow(run, "doc_id long, n long, l int, tokens array<long>")


def _wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, packed``: the compressed texts of the documents ``wanted`` names.

    A filter of fixed size leaves out most others before anything is shuffled.
    """
    some = docs.sparkSession.sparkContext.broadcast(_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, last = some.value.view(np.uint8), None
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            at = _bit(batch.column(0).to_numpy()).astype(np.int64)
            hits = np.flatnonzero(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
            ids, packed = [], []
            for doc, text in zip(batch.column(0).take(pa.array(hits)).to_pylist(), batch.column(1).take(pa.array(hits))):
                row = (doc, zlib.compress(text.as_py() or b"", 1))
                if row != last:
                    last = row
                    ids.append(doc)
                    packed.append(row[1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    return _texts(docs).mapInArrow(run, "doc_id long, packed binary").join(wanted, "doc_id")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections within a block, by matrix products over slices of the shared tokens."""
    where = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    distinct, column, times = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    where, column = where[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    where, column = where[order], column[order]
    width = 4096
    for start in range(0, int((times > 1).sum()), width):
        lo, hi = np.searchsorted(column, [start, start + width])
        rows = np.zeros((len(sets), width), dtype=np.float32)
        rows[where[lo:hi], column[lo:hi] - start] = 1
        out += rows @ rows.T
    return out


def block_links(ids: np.ndarray, prefixes: list[np.ndarray], matches: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within a block of documents."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    rest = sizes - np.array([len(p) for p in prefixes], dtype=np.int64)
    overlap = -(-percent * np.add.outer(sizes, sizes) // (100 + percent))
    need = np.maximum(np.minimum.outer(matches, matches), overlap - np.maximum.outer(rest, rest))
    candidates = _overlaps(prefixes) >= need
    np.fill_diagonal(candidates, False)
    live = np.flatnonzero(candidates.any(axis=1))
    if not len(live):
        return []
    sizes = sizes[live].astype(np.float64)
    common = _overlaps([sets[i] for i in live]).astype(np.float64)
    linked = (100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)) & candidates[np.ix_(live, live)]
    free, out = np.ones(len(live), dtype=bool), []
    for start in range(len(live)):
        if free[start]:
            free[start], front = False, [start]
            while front:
                at = front.pop()
                new = np.flatnonzero(linked[at] & free)
                free[new] = False
                out += [(int(ids[live[at]]), int(ids[live[x]])) for x in new]
                front += new.tolist()
    return out


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, lately = _Words(), {}

        def set_of(packed: bytes) -> np.ndarray:
            found = lately.get(packed)
            if found is None:
                if len(lately) >= 64:
                    lately.clear()
                found = lately[packed] = shingle_set(zlib.decompress(packed), words, k)
            return found

        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            keep = []
            for left, right in zip(x, y):
                s, t = set_of(left.as_py()), set_of(right.as_py())
                common = len(s) + len(t) - len(np.unique(np.concatenate((s, t))))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(chosen), b.filter(chosen)], ["a", "b"])

    one = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("x")), "a")
    two = one.join(texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _hot_links(hot: DataFrame, texts: DataFrame, k: int, percent: int, sketch, load: float) -> DataFrame:
    blocks = hot.withColumn("blocks", F.ceil(F.col("m") / BLOCK))
    own = blocks.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    cells = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc_id")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        words, table = _Words(), sketch.value
        found = []
        for packed in group["packed"]:
            s = shingle_set(zlib.decompress(packed), words, k)
            found.append(prefix(s, table[s >> np.uint64(64 - SKETCH_BITS)].astype(np.int64), load, percent))
        links = block_links(group["doc_id"].to_numpy(), [s[:p] for s, p, _ in found], np.array([l for _, _, l in found]), [s for s, _, _ in found], percent)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return cells.join(texts, "doc_id").groupBy("token", "i", "j").applyInPandas(run, "a long, b long")


def linked(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, n_class``, the size of its class of equal sets."""
    spark = docs.sparkSession
    first = staged(_first_pass(docs, k), "sets")
    rows = first.where("chunk IS NULL").select("doc_id", "n", "sig")
    table = _combined(first.where("chunk IS NOT NULL").select("chunk", "salt", "counts"), 1 << SKETCH_BITS, np.add)
    load = float(table.sum(dtype=np.int64)) / len(table)
    sketch = spark.sparkContext.broadcast(table)
    classes = staged(rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_class")), "classes")
    reps = classes.where("rep IS NOT NULL").select(F.col("rep").alias("doc_id")).distinct()

    prefixes = staged(_prefixes(docs, k, percent, sketch, load).join(reps, "doc_id").dropDuplicates(["doc_id", "tokens"]), "prefixes")
    postings = prefixes.select("doc_id", "n", "l", F.explode("tokens").alias("token"))
    shared = postings.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    live = staged(postings.join(shared, "token"), "postings")

    small = live.where(F.col("m") <= HOT)
    a = small.select("token", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("l").alias("l_a"))
    b = small.select("token", F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("l").alias("l_b"))
    near = (F.col("a") < F.col("b")) & (percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b"))
    rest = [F.ceil(percent * F.col(f"n_{x}") / F.lit(100)) - F.col(f"l_{x}") for x in "ab"]
    overlap = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    need = F.greatest(F.least("l_a", "l_b").cast("long"), overlap - F.greatest(*rest))
    met = a.join(b, "token").where(near).select("a", "b", need.alias("need")).groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("need").alias("need"))
    pairs = staged(met.where("shared >= need").select("a", "b"), "pairs")
    hot = live.where(F.col("m") > HOT).select("token", "m", "doc_id").distinct()

    wanted = staged(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(hot.select("doc_id")).distinct(), "wanted")
    texts = staged(_wanted_texts(docs, wanted), "candidate-texts")
    links = _verified(pairs, texts, k, percent).union(_hot_links(hot, texts, k, percent, sketch, load))
    named = components(links).select(F.col("node").alias("rep"), F.col("component"))

    labelled = classes.join(named, "rep", "left").select("sig", "n_class", F.coalesce("component", "rep").alias("component"))
    out = rows.join(labelled, "sig", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_class", F.lit(1)).cast("long").alias("n_class"),
    )


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest ``doc_id``.

    Rows without ``doc_id`` stay, as they cannot be named; of rows that repeat a kept id one stays.
    """
    gone = linked(docs, k, percent).where("component_id < doc_id").select("doc_id").distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
    repeated = staged(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    # Rows of one id: the first by a hash of the text, then of all columns.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    order = F.struct(F.xxhash64("text"), F.xxhash64(*columns))
    several = kept.join(repeated, "doc_id", "left_semi").select(*columns)
    first = several.groupBy(F.col("doc_id").alias("id")).agg(F.min_by(F.struct(*columns), order).alias("row"))
    return kept.join(repeated, "doc_id", "left_anti").select(*columns).union(first.select("row.*"))
