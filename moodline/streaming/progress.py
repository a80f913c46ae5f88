"""Batches of ten and recent history per client, kept across micro-batches.

State per client: the results of the open batch (fewer than ten), the running
counts, and the last scores, labels and times. The rows that reach a task carry
numbers only, and a micro-batch is bounded by the source's ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from moodline.functions.labels import NEGATIVE, NEUTRAL, POSITIVE, trend_label
from moodline.functions.report import ARROW, symbol
from moodline.operators.batches import (
    BATCH_SIZE,
    SCORE_HISTORY,
    TIME_HISTORY,
    TREND_LENGTH,
    is_label,
    mean_millis,
    mean_score,
    percentages,
    score_steps,
    time_micros,
)

# The state function travels with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COUNTS = ["positive_count", "negative_count", "neutral_count"]
_SIGNS = [1, -1, 0]
# Stands for a missing time among the integers that a task handles.
_MISSING = -(2**63)

_OUTPUT = (
    "client string, batch_id bigint, batch_size bigint, total bigint, "
    "positive_count bigint, negative_count bigint, neutral_count bigint, "
    "positive_total bigint, negative_total bigint, neutral_total bigint, "
    "steps bigint, micros bigint, timed bigint, first_micros bigint, last_micros bigint, "
    "recent_results bigint, recent_steps bigint, recent_timed bigint, recent_micros bigint, signs array<int>"
)
# The four columns of every result kept: score steps, sign of its label, time, event time.
_STATE = "total bigint, positive bigint, negative bigint, neutral bigint, kept binary"
_FIELDS = ["steps", "sign", "micros", "event_micros"]
_KEPT = max(SCORE_HISTORY, TIME_HISTORY, TREND_LENGTH, BATCH_SIZE)


def _ends(values: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Sum of the ``width`` values up to each end."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[ends] - sums[np.maximum(ends - width, 0)]


def _batches(client: str, kept: np.ndarray, fresh: np.ndarray, totals: np.ndarray, final: bool) -> pd.DataFrame:
    """One row per batch that the fresh results complete, and for the open one when ``final``."""
    before = int(totals.sum())
    rows = np.concatenate([kept, fresh])
    count = before + len(fresh)
    ends = np.arange((before // BATCH_SIZE + 1) * BATCH_SIZE, count + 1, BATCH_SIZE)
    if final and count % BATCH_SIZE:
        ends = np.append(ends, count)
    sizes = (ends - 1) % BATCH_SIZE + 1
    at = ends - count + len(rows)  # place of the end among ``rows``
    steps, sign, micros, event = rows.T
    out = {
        "client": client,
        "batch_id": (ends - 1) // BATCH_SIZE + 1,
        "batch_size": sizes,
        "total": ends,
    }
    later = np.maximum(at - len(kept), 0)
    for name, value, total in zip(_COUNTS, _SIGNS, totals):
        of_label = (sign == value).astype(np.int64)
        out[name] = _ends(of_label, at, sizes)
        out[name.replace("count", "total")] = total + np.concatenate([[0], np.cumsum(of_label[len(kept):])])[later]
    out["steps"] = _ends(steps, at, sizes)
    known = micros != _MISSING
    spent, timed = np.where(known, micros, 0), known.astype(np.int64)
    out["micros"] = _ends(spent, at, sizes)
    out["timed"] = _ends(timed, at, sizes)
    spans = [event[a - n : a] for a, n in zip(at, sizes)]
    spans = [span[span != _MISSING] for span in spans]
    out["first_micros"] = pd.array([int(span.min()) if len(span) else None for span in spans], dtype="Int64")
    out["last_micros"] = pd.array([int(span.max()) if len(span) else None for span in spans], dtype="Int64")
    out["recent_results"] = np.minimum(ends, SCORE_HISTORY)
    out["recent_steps"] = _ends(steps, at, np.minimum(ends, SCORE_HISTORY))
    out["recent_timed"] = _ends(timed, at, np.minimum(ends, TIME_HISTORY))
    out["recent_micros"] = _ends(spent, at, np.minimum(ends, TIME_HISTORY))
    out["signs"] = [sign[max(a - TREND_LENGTH, 0) : a].astype(int).tolist() for a in at]
    return pd.DataFrame(out)


def _advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState, idle_ms: int | None) -> Iterator[pd.DataFrame]:
    totals, kept = np.zeros(3, dtype=np.int64), np.empty((0, len(_FIELDS)), dtype=np.int64)
    if state.exists:
        _, *counts, blob = state.get
        totals = np.array(counts, dtype=np.int64)
        kept = np.frombuffer(blob, dtype=np.int64).reshape(-1, len(_FIELDS))
    if state.hasTimedOut:
        state.remove()
        yield _batches(key[0], kept, kept[:0], totals, final=True)
        return
    parts = [chunk[["seq", *_FIELDS]].to_numpy(dtype=np.int64) for chunk in chunks]
    # rows of a key come in no order within a micro-batch
    arrived = np.concatenate(parts)
    fresh = arrived[np.argsort(arrived[:, 0], kind="stable"), 1:]
    yield _batches(key[0], kept, fresh, totals, final=False)
    totals = totals + [int((fresh[:, 1] == value).sum()) for value in _SIGNS]
    kept = np.ascontiguousarray(np.concatenate([kept, fresh])[-_KEPT:])
    state.update((int(totals.sum()), *[int(t) for t in totals], kept.tobytes()))
    if idle_ms is not None:
        state.setTimeoutDuration(idle_ms)


def batch_progress(results: DataFrame, idle_minutes: float | None = 10) -> DataFrame:
    """Stream of batch summaries with the client's totals and recent history at that point.

    Missing times are left out, as ``batches`` does. ``client`` and ``seq`` must be known;
    ``packets.with_arrival`` fills them.

    A client that stays silent for ``idle_minutes`` has ended: its open batch is
    summarised and its state removed. A query that takes what there is and stops needs
    None here, as waiting for silence would keep it running; summarise open batches
    from the stored results then (``batches.batch_summary``).
    """
    sign = F.when(is_label(POSITIVE), 1).when(is_label(NEGATIVE), -1).otherwise(0)
    rows = results.select(
        "client",
        F.coalesce("seq", F.lit(0).cast("bigint")).alias("seq"),
        score_steps().alias("steps"),
        sign.cast("bigint").alias("sign"),
        F.coalesce(time_micros(), F.lit(_MISSING)).alias("micros"),
        F.coalesce(F.unix_micros("event_time"), F.lit(_MISSING)).alias("event_micros"),
    )
    idle_ms = None if idle_minutes is None else int(idle_minutes * 60_000)
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout

    def advance(key, chunks, state):
        return _advance(key, chunks, state, idle_ms)

    emitted = rows.groupBy("client").applyInPandasWithState(
        advance, _OUTPUT, _STATE, "append", timeout
    )
    mean = mean_score(F.col("steps"), F.col("batch_size"))
    recent = mean_score(F.col("recent_steps"), F.col("recent_results"))
    label = lambda s: F.when(s > 0, POSITIVE).when(s < 0, NEGATIVE).otherwise(NEUTRAL)
    shown = F.size("signs") >= TREND_LENGTH
    return emitted.select(
        "client",
        "batch_id",
        "batch_size",
        *_COUNTS,
        *percentages("batch_size"),
        mean.alias("mean_compound"),
        mean_millis(F.col("micros"), F.col("timed")).alias("mean_processing_ms"),
        ((F.col("last_micros") - F.col("first_micros")) / F.lit(1e6)).alias("duration_s"),
        trend_label(mean).alias("trend"),
        "total",
        "positive_total",
        "negative_total",
        "neutral_total",
        mean_millis(F.col("recent_micros"), F.col("recent_timed")).alias("recent_mean_processing_ms"),
        recent.alias("recent_mean_compound"),
        F.when(shown, F.array_join(F.transform("signs", lambda s: symbol(label(s))), ARROW)).alias("recent_symbols"),
    )
