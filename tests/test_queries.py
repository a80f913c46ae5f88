"""Every registered query agrees with its SQL in a second engine, and plans as intended."""

import pytest
from compare import difference, duck

import __spark_entry__ as driver
from moodline.operators import batches, sampling
from moodline.plans import adapters
from moodline.plans.queries import QUERIES


@pytest.fixture(scope="module")
def second_engine(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small_dir, second_engine, name):
    assert difference(QUERIES[name](spark, small_dir), driver.oracle_sql()[name], second_engine) is None


def test_contract(spark):
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).columns[:3] == ["client", "batch_id", "batch_size"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    plan = plan_of(adapters.clean(spark, small_dir).select("id"))
    pushed = plan[plan.index("PushedFilters") :]
    assert all(f in pushed for f in ("IsNotNull(text)", "IsNotNull(lang)", "EqualTo(lang,en)"))
    assert "n_chars" not in plan


@pytest.mark.parametrize("statistic", [batches.batch_summary, batches.running_totals, batches.full_batches, batches.assign_batches])
def test_texts_are_scored_once(spark, small_dir, statistic):
    """Ordered statistics read stored scores: their own plan holds no tokens and no lookup."""
    plan = plan_of(statistic(adapters.results(spark, small_dir)))
    assert "regexp_extract_all" not in plan and "from_json" not in plan
    if statistic is batches.batch_summary:
        assert plan.count("Exchange") == 1 and "text#" not in plan


def test_draws_number_narrow_rows(spark, small_dir):
    drawn = sampling.draw_with_replacement(adapters.clean(spark, small_dir).drop("client"), adapters.sessions(spark, small_dir), 5, order=["seq"])
    plan = plan_of(drawn)
    gathered = [part.split("\n")[1] for part in plan.split("Exchange SinglePartition")[1:]]
    assert any("Project" in line for line in gathered) and not any("text" in line for line in gathered)


def test_draws_are_dealt_to_all_partitions(spark, small_dir):
    drawn = sampling.draw_with_replacement(adapters.clean(spark, small_dir).drop("client"), adapters.sessions(spark, small_dir), 5, order=["seq"])
    assert drawn.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_no_query_builds_pairs(spark, small_dir):
    for name in ("status_snapshot", "draw_with_replacement", "packet_counters", "running_totals", "client_stats"):
        plan = plan_of(QUERIES[name](spark, small_dir))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_chunked_forms_match_on_tables(spark, medium_dir):
    """The same tables cut into many small chunks give the same answers."""
    from moodline.operators import delivery

    log = adapters.log(spark, medium_dir)
    for operator in (delivery.active_connections, delivery.packet_counters, delivery.trailing_rate):
        whole, cut = operator(log), operator(log, chunk_rows=900)
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.select(whole.columns).collect()))
    clean = adapters.clean(spark, medium_dir).drop("client").select("id", "seq")
    clients = adapters.sessions(spark, medium_dir)
    whole = sampling.draw_with_replacement(clean, clients, 5, order=["seq"])
    cut = sampling.draw_with_replacement(clean, clients, 5, order=["seq"], chunk_rows=60)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.select(whole.columns).collect()))
