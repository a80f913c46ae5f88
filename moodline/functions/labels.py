"""Label rules. Thresholds and comparison signs are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE = "positive"
NEGATIVE = "negative"
NEUTRAL = "neutral"
BALANCED = "balanced"


def label_compound(compound: Column, threshold: float = 0.05) -> Column:
    """Positive from ``threshold`` on and negative from ``-threshold`` down, both included."""
    return (
        F.when(compound >= threshold, POSITIVE).when(compound <= -threshold, NEGATIVE).otherwise(NEUTRAL)
    )


def label_polarity(polarity: Column, threshold: float = 0.1) -> Column:
    """Positive above ``threshold`` and negative below ``-threshold``, neither included."""
    return F.when(polarity > threshold, POSITIVE).when(polarity < -threshold, NEGATIVE).otherwise(NEUTRAL)


def trend_label(mean: Column, threshold: float = 0.1) -> Column:
    """Trend of a mean compound score, thresholds not included."""
    return F.when(mean > threshold, POSITIVE).when(mean < -threshold, NEGATIVE).otherwise(BALANCED)
