"""The chunked running values equal plain windows, whatever the skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from moodline.operators import ordered

def one():
    return F.lit(1).cast("bigint")


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows: one key holds half of them, one key is NULL, the others are small."""
    key = (
        F.when(F.col("seq") % 2 == 0, "hot").when(F.col("seq") % 31 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("seq") % 40).cast("string"))
        )
    )
    return (
        spark.range(900)
        .select(F.col("id").alias("seq"), F.pmod(F.xxhash64("id"), F.lit(7)).alias("value"))
        .withColumn("key", key)
        .orderBy(F.xxhash64("seq"))
        .cache()
    )


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("chunk_rows", [23, 200, 10_000])
def test_running_values_equal_plain_window(skewed, keys, chunk_rows):
    frame = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = F.when(F.col("value") % 2 == 1, F.struct("seq", "value"))
    got = ordered.running_values(
        skewed, keys, ["seq"], {"n": one(), "total": F.col("value")}, {"latest": odd}, chunk_rows
    )
    want = skewed.select(
        "*",
        F.count(F.lit(1)).over(frame).alias("n"),
        F.sum("value").over(frame).alias("total"),
        F.max(odd).over(frame).alias("latest"),
    )
    assert rows(got) == rows(want)


def test_a_hot_key_is_spread_over_chunks(skewed):
    cuts = ordered._cut_points(skewed, ["key", "seq"], 900, 20)
    chunks = ordered._chunk_of(skewed, ["key", "seq"], cuts).groupBy("_chunk", "key").count().cache()
    assert chunks.agg(F.max("count")).first()[0] < 200
    assert chunks.filter("key = 'hot'").count() > 4
    # at most one key runs on from one chunk into the next
    spans = chunks.groupBy("key").agg((F.count(F.lit(1)) - 1).alias("crossings"))
    assert spans.agg(F.sum("crossings")).first()[0] <= chunks.select("_chunk").distinct().count() - 1


def test_cut_points_do_not_depend_on_partitions(skewed):
    assert ordered._cut_points(skewed, ["key", "seq"], 900, 20) == ordered._cut_points(
        skewed.repartition(13), ["key", "seq"], 900, 20
    )


@pytest.mark.parametrize("chunk_rows", [30, 10_000])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_trailing_counts_equal_range_window(skewed, keys, chunk_rows):
    """Many rows share an instant here, and one instant holds a third of all rows."""
    timed = skewed.withColumn("us", F.when(F.col("seq") % 3 == 0, 500).otherwise(F.col("value") * 100))
    frame = Window.partitionBy(*keys).orderBy("us").rangeBetween(-199, 0)
    got = ordered.trailing_counts(timed, keys, "us", ["seq"], 200, "n", chunk_rows)
    assert rows(got) == rows(timed.select("*", F.count(F.lit(1)).over(frame).alias("n")))


@pytest.mark.parametrize("chunk_rows", [50, 10_000])
def test_index_numbers_all_rows(skewed, chunk_rows):
    got = ordered.with_index(skewed.repartition(5), ["seq"], "idx", chunk_rows)
    assert got.filter("idx <> seq").count() == 0
    assert got.count() == 900


def test_empty_input(skewed):
    nothing = skewed.filter("false")
    assert ordered.running_values(nothing, ["key"], ["seq"], {"n": one()}).count() == 0
    assert ordered.with_index(nothing, ["seq"]).count() == 0


def test_times_order_in_chunks_as_in_windows(spark):
    rows = [(i, f"2025-01-01 00:{i % 60:02d}:{i // 60:02d}.{i % 7}") for i in range(400)]
    base = spark.createDataFrame(rows, "i int, t string")
    for kind in ("timestamp", "timestamp_ntz"):
        df = base.select("i", F.col("t").cast(kind).alias("t"))
        plain, cut = (ordered.running_values(df, [], ["t", "i"], {"s": F.col("i").cast("bigint")}, chunk_rows=n) for n in (1000, 50))
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.select(plain.columns).collect()))
    for n in (1000, 50):
        with pytest.raises(TypeError, match="double"):
            ordered.running_values(base.select(F.col("i").cast("double").alias("d")), [], ["d"], {"s": F.lit(1)}, chunk_rows=n)


def test_a_hot_key_is_sized_once_for_trailing_counts(spark, monkeypatch):
    sized, sizes = [], ordered._sizes
    monkeypatch.setattr(ordered, "_sizes", lambda df, keys: sized.append(keys) or sizes(df, keys))
    df = spark.range(40).selectExpr("id AS seq", "id div 2 * 7 AS micros", "id % 3 = 0 AS odd")
    whole = ordered.trailing_counts(df, [], "micros", ["seq"], 21)
    cut = ordered.trailing_counts(df, [], "micros", ["seq"], 21, chunk_rows=6)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    assert len(sized) == 2
