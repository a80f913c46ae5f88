"""Labels, lexicon lookup and the scoring levels."""

import math

import pytest
from pyspark.sql import functions as F

from moodline.functions.labels import label_compound, label_polarity, trend_label
from moodline.operators import lexicon as lexicons
from moodline.operators import scoring

WORDS = scoring.Words(["no", "not"], ["very"], ["slightly"])


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [("good", 20, 700, 600), ("bad", -25, -700, 660), ("flat", 0, 0, 100)]
    return lexicons.lexicon_from_rows(spark, rows).cache()


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


def scores(spark, lexicon, level, *values):
    scored = scoring.score_messages(texts(spark, *values), lexicon, level=level, words=WORDS)
    return [row.asDict() for row in scored.orderBy("id").collect()]


@pytest.mark.parametrize(
    "value, by_compound, by_polarity, trend",
    [
        (0.05, "positive", "neutral", "balanced"),
        (0.0499, "neutral", "neutral", "balanced"),
        (-0.05, "negative", "neutral", "balanced"),
        (-0.0499, "neutral", "neutral", "balanced"),
        (0.1, "positive", "neutral", "balanced"),
        (0.1001, "positive", "positive", "positive"),
        (-0.1, "negative", "neutral", "balanced"),
        (-0.1001, "negative", "negative", "negative"),
        (0.0, "neutral", "neutral", "balanced"),
    ],
)
def test_label_boundaries(spark, value, by_compound, by_polarity, trend):
    x = F.col("x")
    row = spark.createDataFrame([(value,)], "x double").select(label_compound(x), label_polarity(x), trend_label(x))
    assert tuple(row.first()) == (by_compound, by_polarity, trend)


def test_tokens_are_ascii_words_in_lower_case(spark):
    got = scoring.tokenize(texts(spark, "Don't STOP, café 12 ok")).orderBy("pos").collect()
    assert [(r.pos, r.token) for r in got] == [(0, "don't"), (1, "stop"), (2, "caf"), (3, "ok")]


def test_plain_scores(spark, lexicon):
    mixed, unknown, blank, missing = scores(spark, lexicon, scoring.PLAIN, "Good good BAD flat x", "x y", "123", None)
    assert mixed["compound"] == compound(2.0 + 2.0 - 2.5)
    whole = 3.0 + 3.0 + 3.5 + 2
    assert (mixed["positive"], mixed["negative"], mixed["neutral"]) == (
        round(6 / whole, 3), round(3.5 / whole, 3), round(2 / whole, 3),
    )
    assert mixed["polarity"] == (700 + 700 - 700 + 0) / 4000
    assert mixed["subjectivity"] == (600 + 600 + 660 + 100) / 4000
    assert (unknown["compound"], unknown["neutral"], unknown["polarity"]) == (0.0, 1.0, 0.0)
    # no tokens is not the same as no text
    assert [blank[c] for c in ("compound", "positive", "negative", "neutral")] == [0.0, 0.0, 0.0, 0.0]
    assert [missing[c] for c in ("compound", "positive", "negative", "neutral", "polarity", "subjectivity")] == [
        0.0, 0.0, 0.0, 1.0, 0.0, 0.0,
    ]


def test_negation_within_three_tokens(spark, lexicon):
    got = scores(spark, lexicon, scoring.NEGATION, "not good", "no a b good", "no a b c good", "no not bad")
    wanted = [2.0 * -0.74, 2.0 * -0.74, 2.0, -2.5 * -0.74]
    assert [g["compound"] for g in got] == [compound(s) for s in wanted]


def test_boosters_fade_with_distance(spark, lexicon):
    got = scores(
        spark, lexicon, scoring.BOOSTERS,
        "very good", "very a good", "very a b good", "very a b c good", "slightly good", "very bad", "very not good",
    )
    wanted = [
        2 + 0.293, 2 + 0.293 * 0.95, 2 + 0.293 * 0.9, 2.0, 2 - 0.293, -2.5 - 0.293, (2 + 0.293 * 0.95) * -0.74,
    ]
    assert [g["compound"] for g in got] == [compound(s) for s in wanted]


def test_emphasis(spark, lexicon):
    got = scores(
        spark, lexicon, scoring.EMPHASIS,
        "GOOD day", "GOOD DAY", "good!", "good!!!!!!", "bad!", "bad but good", "nothing here!",
    )
    wanted = [
        2 + 0.733, 2.0, 2 + 0.292, 2 + 4 * 0.292, -2.5 - 0.292, -2.5 * 0.5 + 2.0 * 1.5, 0.0,
    ]
    assert [g["compound"] for g in got] == [compound(s) for s in wanted]


@pytest.mark.parametrize("level", [scoring.PLAIN, scoring.EMPHASIS])
def test_large_lexicon_gives_the_same(spark, lexicon, level, monkeypatch):
    values = ["Good BAD!", "not good good but very bad", "x", "", None, "Good BAD!", "Good BAD!"]
    small = scores(spark, lexicon, level, *values)
    monkeypatch.setattr(lexicons, "MAX_INDEX_ROWS", 1)
    assert scores(spark, lexicon, level, *values) == small


def test_no_shuffle_of_texts(spark, lexicon):
    plan = scoring.score_messages(texts(spark, "good"), lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_texts_stay_when_few_entries_of_a_large_lexicon_occur(spark, monkeypatch):
    large = lexicons.lexicon_from_rows(spark, [("good", 20, 700, 600), ("bad", -25, -700, 660), ("\u00fc", 1, 1, 1), ("rare", 9, 9, 9), ("odd", 8, 8, 8)])
    values = ["Good BAD!", "not good", "x", "", None, "not good"]
    want = scores(spark, large, scoring.EMPHASIS, *values)
    monkeypatch.setattr(lexicons, "MAX_INDEX_ROWS", 2)
    assert scores(spark, large, scoring.EMPHASIS, *values) == want
    assert scores(spark, large, scoring.EMPHASIS, None, "")[0]["neutral"] == 1.0
    plan = scoring.score_messages(texts(spark, *values), large)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_joined_texts_move_as_texts(spark, lexicon, monkeypatch):
    monkeypatch.setattr(lexicons, "MAX_INDEX_ROWS", 1)
    moved = scoring.score_polarity(texts(spark, "good bad", "bad"), lexicon)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in moved and "_tokens" not in moved


@pytest.mark.parametrize("broadcast_rows", [1, 500_000])
@pytest.mark.parametrize("level", [scoring.PLAIN, scoring.EMPHASIS])
def test_both_joins_give_the_same(spark, lexicon, level, broadcast_rows, monkeypatch):
    values = ["Good BAD!", None, "not good good but very bad", "x", "", None] + 40 * ["Good BAD!"] + ["good " * 100]
    small = scores(spark, lexicon, level, *values)
    monkeypatch.setattr(lexicons, "MAX_INDEX_ROWS", 1)
    monkeypatch.setattr(lexicons, "MAX_BROADCAST_ROWS", broadcast_rows)
    assert scores(spark, lexicon, level, *values) == small
    twice = spark.createDataFrame([(None, "good"), (1, "bad"), (1, "bad"), (None, "good"), (None, None)], "id int, text string")
    got = scoring.score_polarity(twice, lexicon).select("id", "text", "polarity").collect()
    assert sorted(map(str, got)) == sorted(
        f"Row(id={i}, text={t!r}, polarity={p})" for i, t, p in 2 * [(None, "good", 0.7), (1, "bad", -0.7)] + [(None, None, 0.0)]
    )


@pytest.fixture
def joins_as_at_size(spark):
    """Small tables are not broadcast for their size."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_only_texts_move_to_a_lexicon_that_is_broadcast(spark, lexicon, monkeypatch, joins_as_at_size):
    monkeypatch.setattr(lexicons, "MAX_INDEX_ROWS", 1)
    plan = scoring.score_polarity(texts(spark, "good bad", "bad"), lexicon)._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(sent) == 2 and all("hashpartitioning(_row#" in line for line in sent)


def test_hits_of_a_join_are_sent_once(spark, lexicon, monkeypatch, joins_as_at_size):
    monkeypatch.setattr(lexicons, "MAX_INDEX_ROWS", 1)
    monkeypatch.setattr(lexicons, "MAX_BROADCAST_ROWS", 1, raising=False)
    plan = scoring.score_polarity(texts(spark, "good bad", "bad"), lexicon)._jdf.queryExecution().executedPlan().toString()
    salted = [line for line in plan.splitlines() if "Generate explode(" in line and "[_salt#" in line]
    assert len(salted) == 1 and "token#" in salted[0] and "BroadcastHashJoin" not in plan


def test_properties_on_table(spark, medium_dir):
    """The sign follows the valence sum, shares add up, and the split is the known one."""
    from moodline.plans import adapters

    scored = scoring.score_messages(
        adapters.clean(spark, medium_dir), adapters.lexicon(spark), level=scoring.PLAIN, words=adapters.WORDS
    )
    labels = scored.groupBy(label_compound(F.col("compound")).alias("label")).count().collect()
    assert {r.label: r["count"] for r in labels} == {"positive": 102, "negative": 70, "neutral": 445}
    assert scored.filter(F.abs(F.col("positive") + F.col("negative") + F.col("neutral") - 1) > 0.0021).count() == 0
    assert scored.filter(F.abs("compound") > 1).count() == 0


def test_default_lexicon_has_unique_lower_case_tokens(spark):
    table = lexicons.default_lexicon(spark)
    assert table.count() == table.select(F.lower("token")).distinct().count() <= 200
    got = scoring.score_messages(texts(spark, "What a great, helpful answer", "This is awful"), table).orderBy("id")
    up, down = got.collect()
    assert up.compound > 0.5 and down.compound < -0.4


def test_lexicon_from_csv(spark, tmp_path):
    (tmp_path / "lexicon.csv").write_text(
        "token,valence_tenths,polarity_thousandths,subjectivity_thousandths\nfine,8,417,500\n"
    )
    table = lexicons.read_lexicon(spark, str(tmp_path))
    assert [tuple(r) for r in table.collect()] == [("fine", 8, 417, 500)]


@pytest.mark.parametrize("limit", [50_000, 1])
def test_a_repeated_token_is_an_error_at_any_size(spark, monkeypatch, limit):
    monkeypatch.setattr(lexicons, "MAX_INDEX_ROWS", limit)
    twice = lexicons.lexicon_from_rows(spark, [("good", 1, 1, 1), ("bad", 1, 1, 1), ("good", 2, 2, 2)])
    with pytest.raises(ValueError, match="good"):
        scoring.score_messages(spark.createDataFrame([("a",)], "text string"), twice, "text")
