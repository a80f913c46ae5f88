"""Running values over an ordered table, without one-task windows over hot keys.

``sum() over (partition by key order by seq)`` sends all rows of a key to one
task, and all rows of the table to one task when there is no key. So the size of
the largest key is counted first. While it is small, that plain window is used.
Beyond ``CHUNK_ROWS`` the table is cut into chunks of the *whole* order
``(keys, order)``, over which a hot key spreads:

1. a hashed sample of the order columns gives at most ``MAX_CHUNKS - 1`` cut
   points; they depend on the data alone, and are then constants of the plan, so
   a task that is run again puts its rows in the same chunks;
2. each row finds its chunk by binary search over the cut points;
3. a window runs inside ``(chunk, keys)``;
4. every key's total in earlier chunks is added back.

The chunks follow the keys in order, so at most one key runs on from one chunk
into the next. Step 4 therefore joins fewer than ``MAX_CHUNKS`` rows, which is
why that side may be broadcast. Beyond ``MAX_CHUNKS * CHUNK_ROWS``, 4.1 billion
rows, chunks grow with the table: 100 billion rows give about 6 million a chunk,
which a task sorts on disk.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline.session import new_shared_path

CHUNK_ROWS = 250_000
MAX_CHUNKS = 16_384
SAMPLES_PER_CHUNK = 16

_CHUNK = "_chunk"
_UNIT = 2**53
_ORDERED_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def stored(df: DataFrame, label: str = "rows") -> DataFrame:
    """``df`` written once to the shared folder and read back, so that no later job computes it again."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _check_types(df: DataFrame, columns: Sequence[str]) -> None:
    """The same columns are accepted whatever the size of the table."""
    for name in columns:
        if not isinstance(df.schema[name].dataType, _ORDERED_TYPES):
            raise TypeError(f"{name}: cannot order by {df.schema[name].dataType.simpleString()}")


def _comparable(df: DataFrame, name: str) -> Column:
    """A key or order column as an integer or a string, in the same order."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    if isinstance(kind, T.DateType):
        return F.unix_date(name)
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int")
    return F.col(name)


def _sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the table and of its largest key."""
    if not keys:
        total = df.count()
        return total, total
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    row = sizes.agg(F.sum("rows").alias("total"), F.max("rows").alias("largest")).first()
    return row["total"] or 0, row["largest"] or 0


def _cut_points(df: DataFrame, columns: Sequence[str], total: int, chunks: int) -> list[tuple]:
    """Every sixteenth point of a hashed sample, in order: bounded by the number of chunks."""
    rate = min(1.0, chunks * SAMPLES_PER_CHUNK / total)
    unit = F.xxhash64(*columns).bitwiseAND(F.lit(_UNIT - 1)) / F.lit(float(_UNIT))
    values = [_comparable(df, c).alias(f"c{i}") for i, c in enumerate(columns)]
    sampled = df.filter(unit < F.lit(rate)).select(*values).distinct()
    sample = sampled.orderBy(*sampled.columns).collect()
    return [tuple(row) for row in sample[SAMPLES_PER_CHUNK - 1 :: SAMPLES_PER_CHUNK]]


def _chunk_of(df: DataFrame, columns: Sequence[str], cuts: Sequence[tuple]) -> DataFrame:
    """Add ``_chunk``: how many cut points lie at or before the row, by binary search.

    The step of size ``s`` is taken from a position that is a multiple of ``2 s``,
    so it only ever looks at every ``2 s``-th cut point, and gets just those.
    """
    values = [_comparable(df, c).alias(f"c{i}") for i, c in enumerate(columns)]
    fields = df.select(*values).schema.fields
    points = T.ArrayType(T.StructType(fields))
    here = F.struct(*values)
    placed = df.withColumn(_CHUNK, F.lit(0))
    step = 1 << max(0, len(cuts).bit_length() - 1)
    while step >= 1 and cuts:
        level = [dict(zip([f.name for f in fields], cut)) for cut in cuts[step - 1 :: 2 * step]]
        known = F.from_json(F.lit(json.dumps(level)), points)
        reached = F.get(known, F.shiftright(F.col(_CHUNK), int(math.log2(2 * step)))) <= here
        placed = placed.withColumn(
            _CHUNK, F.col(_CHUNK) + F.when(F.coalesce(reached, F.lit(False)), step).otherwise(0)
        )
        step //= 2
    return placed


def running_values(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    maxima: Mapping[str, Column] | None = None,
    chunk_rows: int = CHUNK_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Add inclusive running sums and running maxima per key.

    ``order`` must be unique within a key; keys and order are integers, strings,
    booleans, dates or timestamps. Sums are of integers. Counting the keys runs a job at
    once, unless ``sizes`` gives the rows of the table and of its largest key. With a hot key ``df`` is read three times more, twice only for its keys, order
    and summed columns: ``stored`` it first when those are costly to compute.
    """
    maxima = dict(maxima or {})
    columns = [*keys, *order]
    _check_types(df, columns)
    folds = {name: (F.sum, value) for name, value in sums.items()}
    folds.update({name: (F.max, value) for name, value in maxima.items()})
    others = [c for c in df.columns if c not in folds]
    total, largest = _sizes(df, keys) if sizes is None else sizes
    frame = (Window.unboundedPreceding, Window.currentRow)

    if largest <= chunk_rows:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.select(*others, *[fold(value).over(whole).alias(name) for name, (fold, value) in folds.items()])

    chunks = min(MAX_CHUNKS, math.ceil(total / chunk_rows))
    stepped = df.withColumns({f"_step_{name}": value for name, (_, value) in folds.items()})
    placed = _chunk_of(stepped, columns, _cut_points(df, columns, total, chunks))

    totals = placed.groupBy(_CHUNK, *keys).agg(
        *[fold(f"_step_{name}").alias(f"_step_{name}") for name, (fold, _) in folds.items()]
    )
    # one row per chunk at most for each key
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried_keys = {key: f"_carried_key_{i}" for i, key in enumerate(keys)}
    carried = (
        totals.select(
            F.col(_CHUNK).alias("_carried_chunk"),
            *[F.col(key).alias(alias) for key, alias in carried_keys.items()],
            *[
                fold(f"_step_{name}").over(before).alias(f"_carried_{name}")
                for name, (fold, _) in folds.items()
            ],
            F.count(F.lit(1)).over(before).alias("_chunks_before"),
        )
        .filter(F.col("_chunks_before") > 0)
        .drop("_chunks_before")
    )

    inside = Window.partitionBy(_CHUNK, *keys).orderBy(*order).rowsBetween(*frame)
    local = placed.withColumns(
        {f"_local_{name}": fold(f"_step_{name}").over(inside) for name, (fold, _) in folds.items()}
    )
    same = F.col(_CHUNK) == F.col("_carried_chunk")
    for key, alias in carried_keys.items():
        same = same & F.col(key).eqNullSafe(F.col(alias))
    joined = local.join(F.broadcast(carried), same, "left")
    values = [
        (F.col(f"_local_{name}") + F.coalesce(F.col(f"_carried_{name}"), F.lit(0))).alias(name) for name in sums
    ]
    values += [F.greatest(F.col(f"_local_{name}"), F.col(f"_carried_{name}")).alias(name) for name in maxima]
    return joined.select(*others, *values)


def trailing_counts(
    df: DataFrame,
    keys: Sequence[str],
    micros: str,
    order: Sequence[str],
    width_micros: int,
    name: str = "n",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """For each row, how many rows of its key are newer than ``micros - width`` and not later.

    Rows of the same instant all count, and a row exactly ``width`` old no longer
    does. With small keys this is the difference of two frames that only grow, so a
    burst does not make the frame expensive. With a hot key it is one running sum
    over marks: +1 at t, -1 at t + width, read at t after both.
    """
    total, largest = _sizes(df, keys)
    if largest <= chunk_rows:
        until = Window.partitionBy(*keys).orderBy(micros)
        now = F.count(F.lit(1)).over(until.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        gone = F.count(F.lit(1)).over(until.rangeBetween(Window.unboundedPreceding, -width_micros))
        return df.select("*", (now - gone).alias(name))

    leaves, enters, reads = 0, 1, 2

    def mark(at: Column, kind: int, delta: int) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), F.lit(delta).cast("bigint").alias("delta"))

    at = F.col(micros)
    marks = F.array(mark(at + F.lit(width_micros), leaves, -1), mark(at, enters, 1), mark(at, reads, 0))
    ordering = {*keys, *order}
    marked = df.withColumn("_mark", F.explode(marks)).select(
        *[
            # only the reading mark needs the columns outside the order
            F.col(c) if c in ordering else F.when(F.col("_mark.kind") == reads, F.col(c)).alias(c)
            for c in df.columns
        ],
        F.col("_mark.at").alias("_at"),
        F.col("_mark.kind").alias("_kind"),
        F.col("_mark.delta").alias("_delta"),
    )
    # every row has three marks
    counted = running_values(
        marked, keys, ["_at", "_kind", *order], {name: F.col("_delta")}, chunk_rows=chunk_rows, sizes=(3 * total, 3 * largest)
    )
    return counted.filter(F.col("_kind") == reads).select(*df.columns, name)


def with_index(
    df: DataFrame, order: Sequence[str], name: str = "idx", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Number all rows 0 … n-1 in the given (unique) order."""
    numbered = running_values(df, [], order, {name: F.lit(1).cast("bigint")}, chunk_rows=chunk_rows)
    return numbered.withColumn(name, F.col(name) - 1)
