"""Lexicon scoring of texts, row by row and without a shuffle.

Every value is summed as an integer (``UNIT`` per 1.0 of valence) and divided once,
so that the result does not depend on the order of the sum.

Levels add to each other: 0 plain sum, 1 negation, 2 boosters, 3 emphasis
(capitals, exclamation marks, "but").
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.text import tokens
from moodline.operators.lexicon import with_hits

PLAIN, NEGATION, BOOSTERS, EMPHASIS = 0, 1, 2, 3

# Fixed values of the scoring formula.
UNIT = 100_000_000
NORMALISER = 15
NEGATION_PERCENT = -74
BOOST = 29_300_000
BOOST_PERCENT = {1: 100, 2: 95, 3: 90}  # by distance before the hit
CAPITALS = 73_300_000
EXCLAMATION = 29_200_000
MAX_EXCLAMATIONS = 4
BEFORE_BUT_PERCENT = 50
AFTER_BUT_PERCENT = 150



class Words(NamedTuple):
    """Words that change the valence of the hits behind them."""

    negators: Sequence[str]
    raisers: Sequence[str]
    dampers: Sequence[str]


# Word lists, written down from memory; many entries follow the booster and
# negation lists published with VADER (see ``lexicon.py``).
NEGATORS = (
    "no not never none nobody nothing neither nor nowhere without cannot can't don't doesn't didn't "
    "isn't aren't wasn't weren't won't wouldn't shouldn't couldn't hasn't haven't hadn't ain't hardly rarely"
).split()
RAISERS = (
    "absolutely amazingly completely deeply enormously entirely especially extremely highly hugely incredibly "
    "more most particularly purely quite really remarkably so substantially thoroughly totally unbelievably "
    "utterly very"
).split()
DAMPERS = "almost barely fairly kinda less little marginally occasionally partly scarcely slightly somewhat".split()
DEFAULT_WORDS = Words(NEGATORS, RAISERS, DAMPERS)


def tokenize(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """One row per token: id, position from 0, lower-case token."""
    return df.select(id, F.posexplode(tokens(F.col(text))).alias("pos", "token")).withColumn(
        "token", F.lower("token")
    )


def _sign(value: Column) -> Column:
    return F.signum(value.cast("double")).cast("bigint")


def _is_capitals(token: Column) -> Column:
    """Upper-case letters only, with at least one of them."""
    return (F.upper(token) == token) & (F.lower(token) != token)


def _hit_facts(level: int, words: Words) -> dict[str, Callable[[Column, Column], Column]]:
    """What the level needs to know about the neighbourhood of a hit."""

    def before(tokens: Column, pos: Column, distance: int) -> Column:
        place = pos - F.lit(distance)
        return F.when(place >= 0, F.lower(F.get(tokens, place)))

    def among(group: Sequence[str], token: Column) -> Column:
        return F.coalesce(token.isin(list(group)), F.lit(False))

    def negated(tokens: Column, pos: Column) -> Column:
        return reduce(or_, [among(words.negators, before(tokens, pos, d)) for d in BOOST_PERCENT])

    def boost(tokens: Column, pos: Column) -> Column:
        return reduce(
            add,
            [
                F.when(among(words.raisers, before(tokens, pos, d)), BOOST * percent // 100)
                .when(among(words.dampers, before(tokens, pos, d)), -BOOST * percent // 100)
                .otherwise(0)
                .cast("bigint")
                for d, percent in BOOST_PERCENT.items()
            ],
        )

    facts: dict[str, Callable[[Column, Column], Column]] = {}
    if level >= NEGATION:
        facts["negated"] = negated
    if level >= BOOSTERS:
        facts["boost"] = boost
    if level >= EMPHASIS:
        facts["loud"] = lambda tokens, pos: _is_capitals(F.get(tokens, pos))
    return facts


def _text_facts(level: int) -> dict[str, Callable[[Column, Column], Column]]:
    """Facts of the whole text; not looked for where no hit can need them."""
    if level < EMPHASIS:
        return {}

    def mixed_case(tokens: Column, hits: Column) -> Column:
        loud = F.size(F.filter(tokens, _is_capitals))
        return F.when(F.exists(hits, lambda hit: hit["loud"]), loud < F.size(tokens)).otherwise(F.lit(False))

    def first_but(tokens: Column, hits: Column) -> Column:
        place = F.array_position(F.transform(tokens, F.lower), F.lit("but"))
        return F.when(F.size(hits) > 0, F.nullif(place, F.lit(0)) - 1)

    return {"_mixed_case": mixed_case, "_but": first_but}


def _marks(level: int, text: str) -> Column:
    """What the exclamation marks add, in units."""
    if level < EMPHASIS:
        return F.lit(0).cast("bigint")
    marks = F.length(text) - F.length(F.replace(F.col(text), F.lit("!")))
    return F.least(marks, F.lit(MAX_EXCLAMATIONS)).cast("bigint") * F.lit(EXCLAMATION)


def _valence(hit: Column, level: int) -> Column:
    """Valence of a hit in units: capitals, then boosters, then negation, then "but"."""

    def scaled(value: Column, percent: Column) -> Column:
        # exact: UNIT leaves room for every percentage taken here
        return F.call_function("div", value * percent.cast("bigint"), F.lit(100).cast("bigint"))

    plain = hit["entry"]["valence"].cast("bigint") * F.lit(UNIT // 10)
    value = plain
    if level >= EMPHASIS:
        value = value + F.when(F.col("_mixed_case") & hit["loud"], _sign(plain) * CAPITALS).otherwise(0)
    if level >= BOOSTERS:
        value = value + _sign(plain) * hit["boost"]
    if level >= NEGATION:
        value = scaled(value, F.when(hit["negated"], NEGATION_PERCENT).otherwise(100))
    if level >= EMPHASIS:
        before, after = hit["pos"] < F.col("_but"), hit["pos"] > F.col("_but")
        value = scaled(value, F.when(before, BEFORE_BUT_PERCENT).when(after, AFTER_BUT_PERCENT).otherwise(100))
    return value


def _parts(level: int) -> Column:
    """Sum of the valences, and of each sign with one unit more per hit, and the number felt."""
    zero = F.lit(0).cast("bigint")

    def add_hit(acc: Column, value: Column) -> Column:
        return F.struct(
            (acc["total"] + value).alias("total"),
            (acc["up"] + F.when(value > 0, value + UNIT).otherwise(zero)).alias("up"),
            (acc["down"] + F.when(value < 0, F.lit(UNIT) - value).otherwise(zero)).alias("down"),
            (acc["felt"] + F.when(value != 0, 1).otherwise(0)).alias("felt"),
        )

    start = F.struct(*[zero.alias(name) for name in ("total", "up", "down", "felt")])
    return F.aggregate(F.transform("_hits", lambda hit: _valence(hit, level)), start, add_hit)


def _mean_of_hits(field: str) -> Column:
    total = F.aggregate("_hits", F.lit(0).cast("bigint"), lambda acc, hit: acc + hit["entry"][field])
    return F.coalesce(total / F.nullif(F.size("_hits").cast("bigint") * 1000, F.lit(0)), F.lit(0.0))


def _compound_columns() -> dict[str, Column]:
    """The formula over ``_parts``, ``_marks`` and ``_count``; a NULL text cannot be scored."""
    parts, marks = F.col("_parts"), F.col("_marks")
    total = (parts["total"] + _sign(parts["total"]) * marks) / F.lit(float(UNIT))
    up = parts["up"] + F.when(parts["up"] > parts["down"], marks).otherwise(0)
    down = parts["down"] + F.when(parts["down"] > parts["up"], marks).otherwise(0)
    flat = (F.col("_count") - parts["felt"]) * UNIT
    whole = F.nullif(up + down + flat, F.lit(0))
    unscored = F.col("_unscored")

    def share(part: Column, fallback: float) -> Column:
        return F.when(unscored, fallback).otherwise(F.coalesce(F.round(part / whole, 3), F.lit(0.0)))

    compound = F.round(total / F.sqrt(total * total + NORMALISER), 4)
    return {
        "compound": F.when(unscored, 0.0).otherwise(compound),
        "positive": share(up, 0.0),
        "negative": share(down, 0.0),
        "neutral": share(flat, 1.0),
    }


def score_compound(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "text",
    level: int = EMPHASIS,
    words: Words = DEFAULT_WORDS,
) -> DataFrame:
    """Add compound, positive, negative and neutral.

    A NULL text cannot be scored: 0, 0, 0 and neutral 1. A text without tokens gets 0
    everywhere.
    """
    found = with_hits(df, lexicon, text, _hit_facts(level, words), _text_facts(level))
    scores = _compound_columns()
    return found.withColumns({"_parts": _parts(level), "_marks": _marks(level, text)}).select(
        *df.columns, *[score.alias(name) for name, score in scores.items()]
    )


def score_polarity(df: DataFrame, lexicon: DataFrame, text: str = "text") -> DataFrame:
    """Add polarity in [-1, 1] and subjectivity in [0, 1]; a NULL text gets 0 and 0."""
    return with_hits(df, lexicon, text).select(
        *df.columns,
        _mean_of_hits("polarity").alias("polarity"),
        _mean_of_hits("subjectivity").alias("subjectivity"),
    )


def score_messages(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "text",
    level: int = EMPHASIS,
    words: Words = DEFAULT_WORDS,
) -> DataFrame:
    """Both scores with one tokenisation and one lookup."""
    found = with_hits(df, lexicon, text, _hit_facts(level, words), _text_facts(level))
    means = {"polarity": _mean_of_hits("polarity"), "subjectivity": _mean_of_hits("subjectivity")}
    scores = _compound_columns()
    return found.withColumns({"_parts": _parts(level), "_marks": _marks(level, text), **means}).select(
        *df.columns, *[score.alias(name) for name, score in scores.items()], *means
    )
