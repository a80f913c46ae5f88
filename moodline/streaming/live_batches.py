"""Batches of ten with histories, and arrival order, as steps of ``epochs``.

``batch_step`` gives, per client, a row for every batch that results complete: the
summary of the batch, the totals so far, and the recent means and labels at its end. A
micro-batch is numbered and summed with the operators that split a busy client, and no
task holds the rows of a client. Carried per client: the results of the open batch, and
the sums at the ends of its last ten batches.

``in_order`` puts a step behind a reorder buffer, for results whose micro-batches do
not follow ``seq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodline.operators.batches import BATCH_SIZE, TIME_HISTORY, last_n
from moodline.operators.ordered import CHUNK_ROWS, running_values
from moodline.operators.reports import RESULT_COLUMNS, SUMS, completed_batches, report_steps, reported
from moodline.streaming.epochs import Keep, Step, Tables, read_carried

_RESULT = "client string, seq bigint, compound_score double, compound_sentiment string, processing_time double, event_time timestamp"
_ENDS = "client string, at bigint, " + ", ".join(f"{name} bigint" for name in SUMS)


def batch_step(chunk_rows: int = CHUNK_ROWS) -> Step:
    """Results ``batches``. Rows of a client follow the micro-batches and, within one, ``seq``."""

    def run(batch: DataFrame, before: Tables, keep: Keep) -> tuple[Tables, Tables]:
        fresh = batch.select(*RESULT_COLUMNS).withColumn("place", F.coalesce("seq", F.lit(0).cast("bigint"))).withColumn("fresh", F.lit(1))
        rows = fresh.unionByName(before["open_results"].withColumn("fresh", F.lit(0)))
        numbered = keep(running_values(rows, ["client"], ["fresh", "place"], report_steps(), chunk_rows=chunk_rows), "numbered")

        ends = before["batch_ends"]
        base = ends.groupBy("client").agg(F.max_by(F.struct("at", *SUMS), F.col("at")).alias("base"))
        full = completed_batches(numbered).join(base, "client", "left")
        known = lambda name: F.coalesce(F.col(f"base.{name}"), F.lit(0))
        done = keep(
            full.withColumns(
                {"at": F.col("local") * BATCH_SIZE + known("at")} | {name: F.col(name) + known(name) for name in SUMS}
            ).drop("base"),
            "completed",
        )
        all_ends = ends.unionByName(done.select("client", "at", *SUMS))
        results = reported(done, all_ends)

        last = all_ends.groupBy("client").agg(F.max("at").alias("_last"))
        recent = all_ends.join(last, "client").filter(F.col("at") > F.col("_last") - TIME_HISTORY).drop("_last")
        tail = last_n(numbered, BATCH_SIZE - 1, ["arrival"], ["client"])
        total = F.max("arrival").over(Window.partitionBy("client"))  # nine rows of a client at most
        left = tail.withColumn("_total", total).filter(F.col("arrival") > F.col("_total") - F.col("_total") % BATCH_SIZE)
        waiting = left.select(*RESULT_COLUMNS, ((F.col("arrival") - 1) % BATCH_SIZE + 1).alias("place"))
        return {"batches": results}, {"open_results": waiting, "batch_ends": recent}

    return Step({"open_results": _RESULT + ", place bigint", "batch_ends": _ENDS}, run)


def open_results(spark: SparkSession, path: str) -> DataFrame:
    """The results of every client's open batch, fewer than ten."""
    return read_carried(spark, path, "open_results")


# -- arrival order ----------------------------------------------------------------------


def in_order(step: Step, first: int = 1, patience: int = 3, chunk_rows: int = CHUNK_ROWS) -> Step:
    """``step`` over the results of each client in the order of ``seq``, whatever micro-batch they come in.

    A client's results are numbered ``first``, ``first`` + 1, … A result waits until all
    before it are there, or for ``patience`` epochs: then the gap is given up, and what
    is missing counts as passed. A result whose number is passed, that repeats a waiting
    one, or that lacks ``client`` or ``seq``, is late: it goes to the results
    ``late_results`` and not to the step. Carried: what waits, and the next number of
    every client.
    """

    def run(batch: DataFrame, before: Tables, keep: Keep) -> tuple[Tables, Tables]:
        epoch = before["turns"].agg(F.max("n").alias("n")).first()["n"] or 0
        fresh = batch.select(*RESULT_COLUMNS)
        named = F.col("client").isNotNull() & F.col("seq").isNotNull()
        pool = fresh.filter(named).withColumn("since", F.lit(epoch).cast("bigint")).unionByName(before["early"])
        # of rows with one number the one that came first stays
        twins = Window.partitionBy("client", "seq").orderBy("since", F.xxhash64(*RESULT_COLUMNS))
        pool = pool.withColumn("_twin", F.row_number().over(twins)).join(before["expected"], "client", "left")
        next_seq = F.coalesce("expected", F.lit(first).cast("bigint"))
        passed = (F.col("seq") < next_seq) | (F.col("_twin") > 1)
        judged = keep(pool.withColumn("expected", next_seq).withColumn("_late", passed).drop("_twin"), "pool")
        waiting = judged.filter(~F.col("_late")).drop("_late")

        # numbers up to ``given_up`` no longer wait for others
        over = F.when(F.col("since") <= epoch - patience, F.col("seq"))
        limits = waiting.groupBy("client").agg(F.max(over).alias("given_up"))
        limits = keep(limits.filter(F.col("given_up").isNotNull()), "given-up")
        limited = keep(waiting.join(limits, "client", "left"), "limited")
        start = F.greatest(F.col("expected") - 1, F.coalesce("given_up", F.lit(first - 1)))
        later = F.when(F.col("seq") > start, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        ranked = running_values(limited, ["client"], ["seq"], {"rank": later}, chunk_rows=chunk_rows)
        ready = keep(ranked.withColumn("ready", F.col("seq") - F.col("rank") <= start), "ranked")

        released = ready.filter("ready")
        ended = released.groupBy("client").agg((F.max("seq") + 1).alias("reached"))
        expected = before["expected"].join(ended, "client", "full").select("client", F.coalesce("reached", "expected").alias("expected"))
        results, carried = step.run(released.select(*RESULT_COLUMNS), {name: before[name] for name in step.carried}, keep)
        late = judged.filter("_late").select(*RESULT_COLUMNS).unionByName(fresh.filter(~named))
        return (
            {**results, "late_results": late},
            {
                **carried,
                "early": ready.filter("NOT ready").select(*RESULT_COLUMNS, "since"),
                "expected": expected,
                "turns": batch.sparkSession.createDataFrame([(epoch + 1,)], "n bigint"),
            },
        )

    own = {"early": _RESULT + ", since bigint", "expected": "client string, expected bigint", "turns": "n bigint"}
    return Step({**step.carried, **own}, run)
