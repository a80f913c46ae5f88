"""Maximal periodic runs of words, by suffix trees and Lyndon roots (operator 12).

A run is a stretch of consecutive words with smallest period q, at least
max(MIN_LENGTH, 2 q) words long, that no neighbouring word extends with period q.
Per document:

1. Only words inside a window of WINDOW words that the document holds twice can lie in a
   run, as every word of a run lies in such a window: one that starts at most the run's
   length less q less WINDOW after its start has its copy q later, one that starts at
   least q after it has its copy q earlier, and the two kinds cover the run, whose
   length is at least 2 q and at least q + WINDOW. The windows are found by hash, so
   further words may come along, but none is missed. What is left of a document is put
   together, with a mark of its own after each stretch, so that no run crosses one.
2. Suffix trees of this sequence and of its reversal by Ukkonen's construction, and an
   Euler tour of each. The lowest common ancestor of two leaves is the least string
   depth of the tour between them; a sparse table over the tour answers each query with
   two reads, so the longest common extension of two places takes constant time.
3. The longest Lyndon words that start at each place, for an order of the words and for
   its reverse, end at the next smaller and the next greater suffix in the order of the
   leaves. Every run has one of them as root; each is extended in both directions.

A document is worked on in one task, in memory in proportion to what step 1 leaves of it.

Defined results: NULL, empty and wordless texts have no words and no run, and collapse to
an empty text; texts of any length are read whole; rows are independent, so repeated
rows, ties and missing ids give rows of their own; further columns do not matter. An
empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.llm.tables import bound, words_of

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_LENGTH = 12
# Any length of at most half of MIN_LENGTH keeps step 1 complete.
WINDOW = 6
# Bytes of texts that a task gathers before it hands them on.
HELD = 16 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


class SuffixTree:
    """Suffix tree of a sequence of positive integers, closed by 0; answers longest common extensions."""

    def __init__(self, symbols: list[int]) -> None:
        self._build([*symbols, 0])
        self._walk()

    def _build(self, s: list[int]) -> None:
        """Ukkonen's construction. An edge is found by parent and first symbol; the k-th leaf is suffix k."""
        n, width = len(s), max(s) + 1
        start, end, link, edges, leaves = [0], [0], [0], {}, []
        node, edge, length, open_suffixes = 0, 0, 0, 0
        for i, symbol in enumerate(s):
            open_suffixes += 1
            unlinked = 0
            while open_suffixes:
                if not length:
                    edge = i
                key = node * width + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    first = start[child]
                    span = end[child] - first
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[first + length] == symbol:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    inner = len(start)
                    edges[key] = inner
                    start += (first, i)
                    end += (first + length, n)
                    link += (0, 0)
                    edges[inner * width + symbol] = inner + 1
                    leaves.append(inner + 1)
                    start[child] = first + length
                    edges[inner * width + s[first + length]] = child
                    if unlinked:
                        link[unlinked] = inner
                    unlinked = inner
                open_suffixes -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_suffixes + 1
        self._start, self._end, self._edges, self._width, self._leaves = start, end, edges, width, leaves

    def _walk(self) -> None:
        """Euler tour in the order of symbols: string depths, and where each suffix first stands."""
        m = len(self._start)
        keys = np.fromiter(self._edges.keys(), np.int64, m - 1)
        order = np.argsort(keys)
        children = np.fromiter(self._edges.values(), np.int64, m - 1)[order].tolist()
        bounds = np.searchsorted(keys[order] // self._width, np.arange(m + 1)).tolist()
        start, end, at = self._start, self._end, bounds[:]
        depth, first, tour, path = [0] * m, [0] * m, [0], [0]
        while path:
            node = path[-1]
            place = at[node]
            if place < bounds[node + 1]:
                at[node] = place + 1
                child = children[place]
                below = depth[child] = depth[node] + end[child] - start[child]
                first[child] = len(tour)
                tour.append(below)
                if bounds[child] < bounds[child + 1]:
                    path.append(child)
                else:
                    tour.append(depth[node])
            else:
                path.pop()
                if path:
                    tour.append(depth[path[-1]])
        self.tour = np.array(tour, dtype=np.int32)
        self.first = np.array(first, dtype=np.int64)[self._leaves]
        del self._start, self._end, self._edges, self._leaves

    def ranks(self) -> np.ndarray:
        """Place of every suffix in the order of suffixes."""
        out = np.empty(len(self.first), dtype=np.int64)
        out[np.argsort(self.first)] = np.arange(len(out))
        return out

    def extensions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefix of the suffixes a and b, pair by pair; a and b differ.

        Each query reads the sparse table twice, in the row of its length. Rows are made
        one after another, so that one is held at a time.
        """
        x, y = self.first[a], self.first[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        order = np.argsort(power, kind="stable")
        cuts = np.searchsorted(power[order], np.arange(power.max(initial=0) + 2))
        out, row = np.empty(len(a), dtype=np.int64), self.tour
        for k in range(len(cuts) - 1):
            here = order[cuts[k] : cuts[k + 1]]
            out[here] = np.minimum(row[low[here]], row[high[here] - (1 << k) + 1])
            if len(row) > 1 << k:
                row = np.minimum(row[: -(1 << k)], row[1 << k :])
        return out


def _lyndon_roots(ranks: list[int]) -> tuple[list[int], list[int]]:
    """Start and length of the longest Lyndon words at each place, for both orders."""
    starts, lengths = [], []
    smaller, greater = [], []
    for i in range(len(ranks) - 1, -1, -1):
        rank = ranks[i]
        while smaller and ranks[smaller[-1]] > rank:
            smaller.pop()
        if smaller:
            starts.append(i)
            lengths.append(smaller[-1] - i)
        smaller.append(i)
        while greater and ranks[greater[-1]] < rank:
            greater.pop()
        if greater:
            starts.append(i)
            lengths.append(greater[-1] - i)
        greater.append(i)
    return starts, lengths


def runs_of(symbols: list[int], min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows of start, length and period of all runs of positive integers, by start, then period."""
    n = len(symbols)
    if n < min_length:
        return np.empty((0, 3), dtype=np.int64)
    ahead, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    starts, lengths = _lyndon_roots(ahead.ranks().tolist())
    at, period = np.array(starts, dtype=np.int64), np.array(lengths, dtype=np.int64)
    left = back.extensions(n - at, n - at - period)
    length = left + period + ahead.extensions(at, at + period)
    found = np.column_stack([at - left, length, period])[length >= np.maximum(min_length, 2 * period)]
    # Of two runs with one start the one with the smaller period is shorter, else both would have it.
    return np.unique(found, axis=0)


def _repeated(words: list[bytes]) -> np.ndarray:
    """Whether each word lies in a window of WINDOW words that occurs twice."""
    n = len(words) - WINDOW + 1
    covered = np.zeros(len(words), dtype=bool)
    if n < 2:
        return covered
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for j in range(WINDOW):
        mixed = (mixed ^ h[j : j + n]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed)
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return covered
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    for j in range(WINDOW):
        covered[twice + j] = True
    return covered


def word_runs(words: list[bytes], min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs of a list of words, see ``runs_of``. ``min_length`` is at least twice WINDOW."""
    covered = np.concatenate([[False], _repeated(words), [False]])
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    stretches = [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= min_length]
    if not stretches:
        return np.empty((0, 3), dtype=np.int64)
    codes, symbols, places = {}, [], []
    for a, b in stretches:
        symbols += [codes.setdefault(w, len(codes) + 1) for w in words[a:b]]
        # no word is a number: a mark that no other place has
        symbols.append(codes.setdefault(a, len(codes) + 1))
        places.append(np.arange(a, b + 1))
    found = runs_of(symbols, min_length)
    found[:, 0] = np.concatenate(places)[found[:, 0]]
    return found


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, its number of words, its runs, and its words without repetitions, in one line."""
    if min_length < 2 * WINDOW:
        raise ValueError(f"min_length must be {2 * WINDOW} or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def flushed() -> pa.RecordBatch:
            ids, counts, found, texts = [list(c) for c in zip(*rows)] or [[], [], [], []]
            flat = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            parts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(_RUN))
            arrays = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, parts), pa.array(texts, pa.binary()).cast(pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "text"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                words = (text.as_py() or b"").split()
                found = word_runs(words, min_length)
                rows.append((doc.as_py(), len(words), found, collapsed(words, found)))
                size += len(rows[-1][3]) + 100
                if size > HELD:
                    yield flushed()
                    rows, size = [], 0
        yield flushed()

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, RUNS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in every tenth document, by a checksum of its id, the words from a place on repeat.

    A row without ``doc_id`` keeps its text.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        start = (g % n).cast("int")
        period = (F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))).cast("int")
        again = F.transform(words, lambda w, i: F.when(i < start, w).otherwise(F.get(words, start + (i - start) % period)))
        return F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text"))

    text = F.when(F.coalesce(h % 10 == 0, F.lit(False)), bound(words_of(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and checksums, of rows of ``periodic_runs``."""
    line = lambda r: F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    rows = found.withColumn("longest", longest)
    length, period = F.col("longest.length"), -F.col("longest.less")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
