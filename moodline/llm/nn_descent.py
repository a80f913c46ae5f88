"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 6).

Equal vectors are one node. A forest of random projections cuts the nodes into small
leaves; neighbours within the leaves, and within groups drawn by hash so that no node is
left alone, are the first graph. NN-descent then goes over it in rounds: every node
gathers its neighbours and a sample of the nodes that list it, compares them with each
other where one of a pair is new, and hands each what it found; lists keep the DEGREE
best. Rounds end when few entries change, after ROUNDS at most.

The graph is by Euclidean distance: its lists are mutual and do not all lead to the few
longest vectors. Queries walk it greedily by inner product, which is linear, so that a
step towards a larger one exists until the walk is near the largest. A query starts at
itself, at LANDMARKS nodes drawn by hash and at as many of the longest, keeps the BEAM
best nodes seen, and expands the best ones not yet expanded, EXPAND a step and those
whose lists have come for other queries of its part, until none is left. All that is in
the beam is then scored on the original vectors in double precision. The graph and the
walk see single precision.

Nodes live in parts of about PART nodes, cells of the first tree that follow each other.
An entry of a list carries the part of its node, so parts ask each other for vectors and
lists by name: a round is four exchanges by part and no join, a step of the walk three,
and a row holds what one part tells another. A vector goes to a part once however many
nodes of it want it. Jobs, plans, rows and tasks, which the driver keeps a record of, so
follow the parts and not the pairs. The sizes of the cells, a row for LEAF nodes, are
read by the driver.

Defined results: vectors that are NULL, empty, all zero, or hold NULL or non-finite
components take no part, nor do those whose length is not the most frequent one (the
longer on a tie); of different vectors for one ``vec_id`` the smallest counts and repeated
rows count once; rows without ``vec_id`` take no part; further columns do not matter.
Ties go to the smaller ``vec_id``. An empty table gives no rows.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm.tables import staged

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEIGHBOURS = 20
DEGREE = 40
REVERSE = 24
PER_NODE = 12
ROUNDS = 8
ENOUGH = 0.02
LEAF = 400
TREES = 4
BEAM = 256
EXPAND = 32
LANDMARKS = 128
PART = 4096
BITS = 30

# What one part tells another, or keeps: arrays as bytes, by kind.
BLOBS = "abcdefg"
ROW = "part int, kind int, src long, " + ", ".join(f"{c} binary" for c in BLOBS)
HOME = 0  # nodes (sorted), vectors
GRAPH = 1  # nodes (sorted), entries of each, ids, parts, scores, fresh; src: entries that are fresh
FOUND = 2  # nodes, entries of each, ids, parts, scores
BACK = 3  # nodes, entries of each, ids of src that list them, fresh
MET = 4  # entries of each set, places in the ids, fresh, ids, parts
WORST = 5  # score that an entry must exceed, by node
WANT = 6  # ids whose vectors src wants
VECTORS = 7  # ids, vectors, worst
WANT_LIST = 8  # ids whose lists src wants
LIST = 9  # ids, entries of each, ids, parts
STATE = 10  # queries (sorted), vectors, entries of each beam, ids, parts, scores, done; src: entries to expand
KEPT = (MET, LIST)  # go with the requests of their part until these are answered
Rows = Iterator[tuple]
Inbox = dict[int, list[tuple[int, list[bytes]]]]


def valid(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (array<double>) of the vectors that take part, one per id."""
    e = F.col("embedding")
    rows = vectors.where(F.col("vec_id").isNotNull() & e.isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(finite & F.exists("embedding", lambda x: x != 0))
    size = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (size["d"] if size else 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _ints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int64)


def _parts(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int32)


def _floats(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.float32)


def _flags(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=bool)


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.empty(0, dtype=np.int64)


def _rank(sorted_keys: np.ndarray) -> np.ndarray:
    """Place of each row within its run of equal keys."""
    starts = _starts(sorted_keys)
    return np.arange(len(sorted_keys)) - np.repeat(starts, np.diff(np.r_[starts, len(sorted_keys)]))


def _ends(counts: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(counts, dtype=np.int64)]


def best(u: np.ndarray, w: np.ndarray, s: np.ndarray, k: int, fresh: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """For every u its k best distinct w by score, then by smaller w, with their flags; one not fresh wins."""
    order = np.lexsort((-s, fresh, w, u))
    columns = [c[order] for c in (u, w, s, fresh, *more)]
    u, w = columns[:2]
    first = np.ones(len(u), dtype=bool)
    first[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
    columns = [c[first] for c in columns]
    order = np.lexsort((columns[1], -columns[2], columns[0]))
    columns = [c[order] for c in columns]
    rank = _rank(columns[0])
    return [c[rank < k] for c in columns]


def _drawn(ids: np.ndarray, turn: int) -> np.ndarray:
    """Numbers that look drawn at random, the same for an id wherever it is."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(turn + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _lists_to(kind: int, src: int, to: np.ndarray, u: np.ndarray, *columns: np.ndarray) -> Rows:
    """A row for each part in ``to``: its u, sorted, how many entries each has, and the entries in their order."""
    order = np.lexsort((u, to))
    to, u, *columns = (c[order] for c in (to, u, *columns))
    starts = _starts(to)
    for lo, hi in zip(starts, np.r_[starts[1:], len(to)]):
        at = _starts(u[lo:hi])
        yield int(to[lo]), kind, src, u[lo:hi][at], np.diff(np.r_[at, hi - lo]).astype(np.int32), *(c[lo:hi] for c in columns)


def _asks(kind: int, src: int, ids: np.ndarray, parts: np.ndarray) -> Rows:
    """A row for each part that is asked for ids, each once."""
    ids, at = np.unique(ids, return_index=True)
    parts = parts[at]
    order = np.argsort(parts, kind="stable")
    ids, parts = ids[order], parts[order]
    starts = _starts(parts)
    for lo, hi in zip(starts, np.r_[starts[1:], len(parts)]):
        yield int(parts[lo]), kind, src, ids[lo:hi]


def _told(rows: Rows) -> Iterator[pa.RecordBatch]:
    """Rows of ROW in batches of some 16 MB."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * len(BLOBS)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], ["part", "kind", "src", *BLOBS])

    for part, kind, src, *blobs in rows:
        raw = [x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes() for x in blobs]
        held.append((part, kind, src, *raw, *[b""] * (len(BLOBS) - len(raw))))
        size += sum(map(len, raw))
        if size > 1 << 24:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _work(rows: DataFrame, work: Callable[[int, Inbox], Rows], out: Callable[[Rows], Iterator[pa.RecordBatch]] = _told, schema: str = ROW) -> DataFrame:
    """What ``work`` makes of the rows of each part that a task has, in an order that does not depend on how they came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inbox: dict[int, Inbox] = defaultdict(lambda: defaultdict(list))
        for batch in batches:
            part, kind, src, *blobs = (c.to_pylist() for c in batch.columns)
            for i in range(len(part)):
                inbox[part[i]][kind[i]].append((src[i], [b[i] for b in blobs]))
        for part in sorted(inbox):
            for told in inbox[part].values():
                told.sort()
            yield from out(work(part, inbox[part]))

    return rows.mapInArrow(run, schema)


def _at_parts(frames: list[DataFrame], parts: int, work: Callable[[int, Inbox], Rows], **out) -> DataFrame:
    """``work`` on all rows for a part, brought together."""
    return _work(reduce(DataFrame.union, frames).repartitionById(parts, F.col("part")), work, **out)


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=np.float32).reshape(len(raw), -1)


def _nodes(classes: DataFrame, dimension: int) -> DataFrame:
    """``u, h1, h2, x, exact, half, codes``: one node per different vector, named by its smallest id: in single and in double precision, half its squared length, and on which sides of the planes of each tree it is."""
    planes = np.random.default_rng(11).standard_normal((TREES, dimension, BITS)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = 1 << np.arange(BITS, dtype=np.int64)[::-1]
        for batch in batches:
            exact = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1) if len(batch) else np.empty((0, dimension))
            x = exact.astype(np.float32)
            codes = np.stack([(x @ p > 0) @ sides for p in planes], axis=1).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * TREES), pa.array(codes.ravel()))
            half = pa.array((exact * exact).sum(axis=1) / 2, pa.float64())
            raw = [pa.array([v.tobytes() for v in m], pa.binary()) for m in (x, exact)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *raw, half, lists], ["u", "h1", "h2", "x", "exact", "half", "codes"])

    return classes.select("u", "h1", "h2", "embedding").mapInArrow(run, "u long, h1 long, h2 long, x binary, exact binary, half double, codes array<long>")


def _cut(sizes: list[tuple[int, int]], most: int) -> tuple[list[tuple[int, int, int]], int]:
    """Cells, in their order, to parts of at most ``most`` nodes: cell, its first part, how many; and the number of parts. Only a cell that is larger has several."""
    out, at, filled = [], 0, 0
    for cell, n in sorted(sizes):
        if filled and filled + n > most:
            at, filled = at + 1, 0
        many = math.ceil(n / most)
        out.append((cell, at, many))
        at, filled = (at + many, 0) if many > 1 else (at, filled + n)
    return out, at + (filled > 0)


def _placed(nodes: DataFrame, n: int) -> tuple[DataFrame, int, int]:
    """The nodes with their ``part``, the number of parts, and the bits of a code that count for n nodes."""
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, n) / LEAF))))
    cell = F.shiftright(F.col("codes")[0], BITS - bits)
    sizes = nodes.groupBy(cell.alias("cell")).count().collect()
    cells, parts = _cut([(r["cell"], r["count"]) for r in sizes], min(PART, max(256, n // 12)))
    table = nodes.sparkSession.createDataFrame(cells, "cell long, first long, many long")
    part = (F.col("first") + F.pmod(F.xxhash64("u", F.lit(5)), F.col("many"))).cast("int").alias("part")
    return nodes.withColumn("cell", cell).join(F.broadcast(table), "cell").select(*nodes.columns, part), parts, bits


def _homes(nodes: DataFrame, x: str, parts: int) -> DataFrame:
    """Rows of HOME with the vectors of column x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[], [], []]
        for batch in batches:
            for c, more in zip(columns, batch.columns):
                c += more.to_pylist()
        part, u = np.array(columns[0], dtype=np.int64), np.array(columns[1], dtype=np.int64)
        order = np.lexsort((u, part))
        starts = _starts(part[order])
        yield from _told((int(part[at[0]]), HOME, 0, u[at], b"".join(columns[2][i] for i in at)) for at in np.split(order, starts[1:]) if len(at))

    return nodes.select("part", "u", x).repartitionById(parts, F.col("part")).mapInArrow(run, ROW)


def _closeness(x: np.ndarray) -> np.ndarray:
    """Half the squared distances of all pairs of rows, negative, for each matrix. Taken from their mean, so that near ones differ."""
    y = x.astype(np.float64)
    y -= y.mean(axis=-2, keepdims=True)
    half = (y * y).sum(axis=-1) / 2
    s = y @ np.swapaxes(y, -1, -2)
    s -= half[..., :, None]
    s -= half[..., None, :]
    return s


def _leaves(nodes: DataFrame, n: int, bits: int, parts: int) -> DataFrame:
    """Exact neighbours within the leaves of a forest of random projections and groups drawn by hash, in rows of FOUND."""
    drawn = F.pmod(F.xxhash64("u"), F.lit(max(1, n // LEAF)))
    codes = F.concat(F.transform("codes", lambda c: F.shiftright(c, BITS - bits)), F.array(drawn))
    sizes = nodes.select(F.posexplode(codes).alias("tree", "code")).groupBy("tree", "code").agg(F.count("*").alias("n"))
    each = nodes.select("u", "part", "x", F.posexplode(codes).alias("tree", "code"))
    # A leaf that is too large is dealt by hash into parts that are not. There is a size for LEAF nodes and tree.
    piece = F.pmod(F.xxhash64("u", "tree"), F.ceil(F.col("n") / (2 * LEAF))).alias("piece")
    dealt = each.join(F.broadcast(sizes), ["tree", "code"]).select("tree", "code", piece, "u", "part", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        tree, code, piece, u, part = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(5))
        x = np.concatenate([_matrix(b.column(5).to_pylist()) for b in held])
        order = np.lexsort((u, piece, code, tree))
        tree, code, piece, u, part = (c[order] for c in (tree, code, piece, u, part))
        new = np.r_[False, (tree[1:] != tree[:-1]) | (code[1:] != code[:-1]) | (piece[1:] != piece[:-1])]
        found = []
        for lo, hi in zip(np.r_[0, np.flatnonzero(new)], np.r_[np.flatnonzero(new), len(u)]):
            k = min(DEGREE, hi - lo - 1)
            if k < 1:
                continue
            s = _closeness(x[order[lo:hi]])
            np.fill_diagonal(s, -np.inf)
            top = np.argpartition(s, hi - lo - k, axis=1)[:, hi - lo - k :]
            scores = np.take_along_axis(s, top, axis=1).astype(np.float32).ravel()
            found.append((np.repeat(part[lo:hi], k), np.repeat(u[lo:hi], k), u[lo:hi][top.ravel()], part[lo:hi][top.ravel()].astype(np.int32), scores))
        if found:
            # Rows of a task are told from those of others by its first leaf.
            src = int(tree[0]) << 60 | int(code[0]) << 24 | int(piece[0])
            yield from _told(_lists_to(FOUND, src, *(np.concatenate(c) for c in zip(*found))))

    return dealt.repartition(max(1, parts * (TREES + 1)), "tree", "code", "piece").mapInArrow(run, ROW)


def _merged(part: int, inbox: Inbox) -> Rows:
    """The DEGREE best of what the lists of a part had and of what was found; the latter is fresh."""
    for _, (raw, *old) in inbox.get(HOME, []) + inbox.get(GRAPH, []):
        us = _ints(raw)
        entries = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32), np.empty(0, bool), np.empty(0, np.int32))]
        if inbox.get(GRAPH):
            ids = _ints(old[1])
            entries.append((np.repeat(np.arange(len(us)), _parts(old[0])), ids, _floats(old[3]), np.zeros(len(ids), dtype=bool), _parts(old[2])))
        for _, (u, counts, ids, parts, scores, *_) in inbox.get(FOUND, []):
            at = np.repeat(np.searchsorted(us, _ints(u)), _parts(counts))
            entries.append((at, _ints(ids), _floats(scores), np.ones(len(at), dtype=bool), _parts(parts)))
        at, ids, scores, fresh, parts = best(*(np.concatenate(c) for c in list(zip(*entries))[:3]), DEGREE, *(np.concatenate(c) for c in list(zip(*entries))[3:]))
        yield part, GRAPH, int(fresh.sum()), us, np.bincount(at, minlength=len(us)).astype(np.int32), ids, parts, scores, fresh


def _backwards(turn: int) -> Callable[[int, Inbox], Rows]:
    """To the parts of the nodes that a part's lists name: a sample of which nodes do."""

    def work(part: int, inbox: Inbox) -> Rows:
        for _, (us, counts, ids, parts, _, fresh, *_) in inbox[GRAPH]:
            u, v = np.repeat(_ints(us), _parts(counts)), _ints(ids)
            order = np.lexsort((u, _drawn(u, turn), v))
            order = order[_rank(v[order]) < REVERSE]
            yield from _lists_to(BACK, part, _parts(parts)[order], v[order], u[order], _flags(fresh)[order])

    return work


def _meetings(turn: int) -> Callable[[int, Inbox], Rows]:
    """For each node of a part the neighbours and listing nodes that are to meet, where one of them is new; their vectors are asked for."""

    def work(part: int, inbox: Inbox) -> Rows:
        for _, (us, counts, ids, parts, scores, fresh, *_) in inbox[GRAPH]:
            us, counts, scores = _ints(us), _parts(counts), _floats(scores)
            ends = _ends(counts)[1:]
            worst = np.full(len(us), -np.inf, dtype=np.float32)
            worst[counts >= DEGREE] = scores[ends[counts >= DEGREE] - 1]
            yield part, WORST, 0, worst
            back = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool))]
            for src, (v, n, u, new, *_) in inbox.get(BACK, []):
                at = np.repeat(np.searchsorted(us, _ints(v)), _parts(n))
                back.append((at, _ints(u), np.full(len(at), src, dtype=np.int32), _flags(new)))
            back = [np.concatenate(c) for c in zip(*back)]
            order = np.lexsort((back[1], _drawn(back[1], turn), back[0]))
            order = order[_rank(back[0][order]) < REVERSE]
            ahead = (np.repeat(np.arange(len(us)), counts), _ints(ids), _parts(parts), _flags(fresh))
            v, ids, parts, new = (np.concatenate([a, b[order]]) for a, b in zip(ahead, back))
            any_new = np.zeros(len(us), dtype=bool)
            any_new[v[new]] = True
            v, ids, parts, new = (c[any_new[v]] for c in (v, ids, parts, new))
            if not len(v):
                return
            members, at, place = np.unique(ids, return_index=True, return_inverse=True)
            parts = parts[at]
            key = v * len(members) + place
            order = np.argsort(key, kind="stable")
            starts = _starts(key[order])
            new = np.logical_or.reduceat(new[order], starts)
            v, place = v[order][starts], place[order][starts]
            at = _starts(v)
            yield part, MET, 0, np.diff(np.r_[at, len(v)]).astype(np.int32), place.astype(np.int32), new, members, parts
            yield from _asks(WANT, part, members, parts)

    return work


def _answers(part: int, inbox: Inbox) -> Rows:
    """The vectors that parts ask for, each once."""
    for kind in KEPT:
        for src, blobs in inbox.get(kind, []):
            yield part, kind, src, *blobs
    wants = defaultdict(list)
    for src, (ids, *_) in inbox.get(WANT, []):
        wants[src].append(_ints(ids))
    for _, (us, x, *_) in inbox.get(HOME, []):
        us = _ints(us)
        # bytes, of either precision
        x = np.frombuffer(x, dtype=np.uint8).reshape(len(us), -1)
        worst = [_floats(blobs[0]) for _, blobs in inbox.get(WORST, [])]
        for src, ids in sorted(wants.items()):
            ids = np.unique(np.concatenate(ids))
            at = np.searchsorted(us, ids)
            yield src, VECTORS, part, ids, x[at], *(w[at] for w in worst)


def _found(part: int, inbox: Inbox) -> Rows:
    """What the meetings of a part find, to the parts of the nodes: for each the DEGREE best that it did not have."""
    if not inbox.get(MET):
        return
    ((_, (counts, place, fresh, members, parts, *_)),) = inbox[MET]
    counts, place, fresh, members, parts = _parts(counts), _parts(place), _flags(fresh), _ints(members), _parts(parts)
    x = worst = None
    for _, (ids, vectors, bounds, *_) in inbox[VECTORS]:
        at = np.searchsorted(members, _ints(ids))
        vectors = _floats(vectors).reshape(len(at), -1)
        if x is None:
            x, worst = np.empty((len(members), vectors.shape[1]), dtype=np.float32), np.empty(len(members), dtype=np.float32)
        x[at], worst[at] = vectors, _floats(bounds)
    begin, most = _ends(counts), int(counts.max())
    step = max(1, (1 << 20) // (most * max(most, x.shape[1])))
    k = min(PER_NODE, most)
    diagonal = np.eye(most, dtype=bool)
    pairs = [(np.empty(0, np.int64), np.empty(0, np.float32))]
    for lo in range(0, len(counts), step):
        n = counts[lo : lo + step, None]
        at = begin[lo : lo + len(n), None] + np.minimum(np.arange(most), n - 1)
        real, who = np.arange(most) < n, place[at]
        new = fresh[at] & real
        s = _closeness(x[who])
        s[~(s > worst[who][:, :, None]) | ~(new[:, :, None] | new[:, None, :]) | ~(real[:, :, None] & real[:, None, :]) | diagonal] = -np.inf
        top = np.argpartition(s, most - k, axis=2)[:, :, most - k :]
        score = np.take_along_axis(s, top, axis=2)
        good = score > -np.inf
        other = np.take_along_axis(np.broadcast_to(who[:, None, :], s.shape), top, axis=2)
        pairs.append(((who[:, :, None].astype(np.int64) * len(members) + other)[good], score[good].astype(np.float32)))
    key, score = (np.concatenate(c) for c in zip(*pairs))
    key, at = np.unique(key, return_index=True)
    u, w = np.divmod(key, len(members))
    # Members are sorted, so that ties stay with the smaller id.
    order = np.lexsort((-score[at], u))
    order = order[_rank(u[order]) < DEGREE]
    u, w = u[order], w[order]
    yield from _lists_to(FOUND, part, parts[u], members[u], members[w], parts[w], score[at][order])


def neighbour_graph(nodes: DataFrame, homes: DataFrame, n: int, bits: int, parts: int) -> DataFrame:
    """Rows of GRAPH, one per part."""
    empty = F.lit(b"")
    names = homes.select("part", "kind", "src", "a", *[empty.alias(c) for c in BLOBS[1:]])
    graph = staged(_at_parts([names, _leaves(nodes, n, bits, parts)], parts, _merged), "graph")
    for turn in range(ROUNDS):
        met = _at_parts([graph, _work(graph, _backwards(turn))], parts, _meetings(turn))
        found = _at_parts([_at_parts([homes, met], parts, _answers)], parts, _found)
        graph = staged(_at_parts([graph, found], parts, _merged), "graph")
        changed = graph.agg(F.sum("src")).first()[0] or 0
        if changed <= ENOUGH * DEGREE * n:
            break
    return graph


def _state(starts: DataFrame, parts: int) -> DataFrame:
    """Rows of STATE, of queries that have seen nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = defaultdict(list)
        for batch in batches:
            for part, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[part].append(u)
        yield from _told((part, STATE, len(u), np.array(sorted(u), dtype=np.int64), b"", np.zeros(len(u), dtype=np.int32)) for part, u in sorted(held.items()))

    return starts.select("part", "u").repartitionById(parts, F.col("part")).mapInArrow(run, ROW)


def _expand(part: int, inbox: Inbox) -> Rows:
    """The lists that the queries of a part want: of the best of a beam that were not expanded."""
    for _, (_, _, counts, ids, parts, _, done) in inbox[STATE]:
        # Beams are sorted by score.
        at = np.flatnonzero(~_flags(done))
        query = np.repeat(np.arange(len(_parts(counts))), _parts(counts))[at]
        at = at[_rank(query) < EXPAND]
        yield from _asks(WANT_LIST, part, _ints(ids)[at], _parts(parts)[at])


def _lists(part: int, inbox: Inbox) -> Rows:
    """The lists that parts ask for; the vectors of what is in them are asked for on their behalf."""
    for _, (us, counts, ids, parts, *_) in inbox.get(GRAPH, []):
        us, counts, ids, parts = _ints(us), _parts(counts), _ints(ids), _parts(parts)
        begin = _ends(counts)
        for src, (wanted, *_) in inbox.get(WANT_LIST, []):
            u = np.searchsorted(us, _ints(wanted))
            n = counts[u]
            at = np.repeat(begin[u] - _ends(n)[:-1], n) + np.arange(n.sum())
            yield src, LIST, part, wanted, n, ids[at], parts[at]
            yield from _asks(WANT, src, ids[at], parts[at])


def _begin(landmarks: np.ndarray, at: np.ndarray) -> Callable[[int, Inbox], Rows]:
    """The vectors of the queries and of the landmarks are asked for."""

    def work(part: int, inbox: Inbox) -> Rows:
        for _, (ts, *_) in inbox[STATE]:
            ts = _ints(ts)
            yield from _asks(WANT, part, np.concatenate([ts, landmarks]), np.concatenate([np.full(len(ts), part, dtype=np.int32), at]))

    return work


def _vectors(inbox: Inbox, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, sorted, with parts and vectors; none where all lists that came are empty."""
    if not inbox.get(VECTORS):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32), np.empty((0, 1), dtype=kind)
    ids = np.concatenate([_ints(blobs[0]) for _, blobs in inbox[VECTORS]])
    parts = np.concatenate([np.full(len(blobs[0]) // 8, src, dtype=np.int32) for src, blobs in inbox[VECTORS]])
    x = np.concatenate([np.frombuffer(blobs[1], dtype=kind).reshape(len(blobs[0]) // 8, -1) for _, blobs in inbox[VECTORS]])
    order = np.argsort(ids)
    return ids[order], parts[order], x[order]


def _places(ids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ids would be among sorted ones, and whether they are there."""
    if not len(among):
        return np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=bool)
    at = np.minimum(np.searchsorted(among, ids), len(among) - 1)
    return at, among[at] == ids


def _walked(landmarks: np.ndarray | None) -> Callable[[int, Inbox], Rows]:
    """Beams after all entries whose lists are here were expanded; at first, after the landmarks."""

    def work(part: int, inbox: Inbox) -> Rows:
        if not inbox.get(STATE):
            return
        ((_, (ts, tx, counts, ids, parts, scores, done)),) = inbox[STATE]
        names, homes, x = _vectors(inbox, np.float32)
        ts, counts, ids, parts, scores, done = _ints(ts), _parts(counts), _ints(ids), _parts(parts), np.frombuffer(scores), _flags(done)
        tx = x[np.searchsorted(names, ts)] if landmarks is not None else _floats(tx).reshape(len(ts), -1)
        listed = [np.concatenate(c) for c in zip(*((_ints(u), _parts(n), _ints(w)) for _, (u, n, w, *_) in inbox.get(LIST, [])))] or [np.empty(0, np.int64)] * 3
        order = np.argsort(listed[0])
        expandable, sizes, begin = listed[0][order], listed[1][order], _ends(listed[1])[:-1][order]
        inside = np.searchsorted(names, listed[2])
        bounds = _ends(counts)
        seen = np.zeros(len(names), dtype=bool)
        out = []
        for i, t in enumerate(ts):
            own = tx[i].astype(np.float64)
            b, p, s, d = (c[bounds[i] : bounds[i + 1]] for c in (ids, parts, scores, done))
            seen[:] = False
            at, there = _places(b, names)
            seen[at[there]] = True
            near = np.searchsorted(names, np.union1d(landmarks, t)) if landmarks is not None else None
            while True:
                if near is None:
                    at, there = _places(b, expandable)
                    there &= ~d
                    if not there.any():
                        break
                    d = d | there
                    at = at[there]
                    near = inside[np.repeat(begin[at] - _ends(sizes[at])[:-1], sizes[at]) + np.arange(sizes[at].sum())]
                near = np.unique(near[~seen[near]])
                seen[near] = True
                # Summed by row: the same for a pair whatever comes with it, so that what has left a beam stays out.
                score = (x[near] * own).sum(axis=1)
                if len(b) == BEAM:
                    near, score = near[score >= s[-1]], score[score >= s[-1]]
                b, p, s, d = (np.concatenate(c) for c in ((b, names[near]), (p, homes[near]), (s, score), (d, np.zeros(len(near), dtype=bool))))
                order = np.lexsort((b, -s))[:BEAM]
                b, p, s, d = b[order], p[order], s[order], d[order]
                near = None
            out.append((b, p, s, d))
        counts = np.array([len(r[0]) for r in out], dtype=np.int32)
        ids, parts, scores, done = (np.concatenate(c) for c in zip(*out))
        yield part, STATE, int((~done).sum()), ts, tx, counts, ids, parts.astype(np.int32), scores.astype(np.float64), done

    return work


def _walk(graph: DataFrame, homes: DataFrame, nodes: DataFrame, starts: DataFrame, parts: int) -> DataFrame:
    """Rows of STATE: what greedy walks from the nodes of ``starts`` have as their BEAM best."""
    # At most 2 LANDMARKS ids, the same for all queries.
    drawn = nodes.orderBy(F.xxhash64("u", F.lit(7)), "u").limit(LANDMARKS).select("u", "part")
    longest = nodes.orderBy(F.desc("half"), "u").limit(LANDMARKS).select("u", "part")
    found = dict(sorted((r["u"], r["part"]) for r in drawn.union(longest).collect()))
    landmarks, at = np.array(list(found), dtype=np.int64), np.array(list(found.values()), dtype=np.int32)
    state = staged(_state(starts, parts), "beam")
    asked = _work(state, _begin(landmarks, at))
    first: np.ndarray | None = landmarks
    while True:
        answers = _at_parts([homes, asked], parts, _answers)
        state = staged(_at_parts([state, answers], parts, _walked(first)), "beam")
        first = None
        if not state.agg(F.sum("src")).first()[0]:
            return state
        asked = _at_parts([graph, _work(state, _expand)], parts, _lists)


def _scored(state: DataFrame, exact: DataFrame, parts: int, k: int) -> DataFrame:
    """``u, w, score``: for each walk the k nodes of largest inner product with its own, of its beam and itself."""

    def asks(part: int, inbox: Inbox) -> Rows:
        for _, (ts, _, _, ids, places, *_) in inbox[STATE]:
            ts = _ints(ts)
            yield from _asks(WANT, part, np.concatenate([ts, _ints(ids)]), np.concatenate([np.full(len(ts), part, dtype=np.int32), _parts(places)]))

    def work(part: int, inbox: Inbox) -> Rows:
        if not inbox.get(STATE):
            return
        ((_, (ts, _, counts, ids, *_)),) = inbox[STATE]
        names, _, x = _vectors(inbox, np.float64)
        ts = _ints(ts)
        t = np.concatenate([np.repeat(np.arange(len(ts)), _parts(counts)), np.arange(len(ts))])
        w = np.searchsorted(names, np.concatenate([_ints(ids), ts]))
        t, w = np.divmod(np.unique(t * len(names) + w), len(names))
        own, columns = np.searchsorted(names, ts)[t], np.ascontiguousarray(x.T)
        score = np.zeros(len(t))
        with np.errstate(all="ignore"):
            for c in columns:
                score += c[own] * c[w]
        # NaN is the largest, as it is for Spark.
        order = np.lexsort((w, -score, ~np.isnan(score), t))
        order = order[_rank(t[order]) < k]
        yield ts[t[order]], names[w[order]], score[order]

    def out(rows: Rows) -> Iterator[pa.RecordBatch]:
        for u, w, score in rows:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(w, pa.int64()), pa.array(score, pa.float64())], ["u", "w", "score"])

    answers = _at_parts([exact, _work(state, asks)], parts, _answers)
    return _at_parts([state, answers], parts, work, out=out, schema="u long, w long, score double")


def search(vectors: DataFrame, every: int = 20, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for each ``vec_id`` divisible by ``every``."""
    rows = staged(valid(vectors).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")}), "vectors")
    first = rows.take(1)
    if not first:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    least = rows.groupBy("h1", "h2").agg(F.min(F.struct("vec_id", "embedding")).alias("m"))
    classes = staged(_nodes(least.select(F.col("m.vec_id").alias("u"), F.col("m.embedding").alias("embedding"), "h1", "h2"), len(first[0]["embedding"])), "nodes")
    n = classes.count()
    nodes, parts, bits = _placed(classes, n)
    homes = staged(_homes(nodes, "x", parts), "homes")
    graph = neighbour_graph(nodes, homes, n, bits, parts)

    queries = rows.where(F.col("vec_id") % every == 0).select("h1", "h2", F.col("vec_id").alias("query_id")).join(classes.select("h1", "h2", "u"), ["h1", "h2"]).select("query_id", "u")
    starts = queries.select("u").distinct().join(nodes.select("u", "part"), "u")
    state = _walk(graph, homes, nodes, starts, parts)
    # Of the nodes, the k + 1 best are enough, as each has its own id at least.
    scores = _scored(state, _homes(nodes, "exact", parts), parts, k + 1)
    # Of equal vectors the k + 1 smallest ids are enough: the query itself may be one.
    ordered = Window.partitionBy("h1", "h2").orderBy("vec_id")
    members = rows.select("h1", "h2", "vec_id").withColumn("r", F.row_number().over(ordered)).where(F.col("r") <= k + 1).drop("r")
    top = Window.partitionBy("u").orderBy(F.desc("score"), "vec_id")
    hashed = scores.join(classes.select(F.col("u").alias("w"), "h1", "h2"), "w")
    listed = hashed.join(members, ["h1", "h2"]).withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1)
    lists = listed.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    answers = queries.join(lists, "u")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = answers.select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
