"""Display functions of the reports."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed display values.
SYMBOLS = {"positive": "😊", "negative": "😞", "neutral": "😐"}
UNKNOWN_SYMBOL = "🤔"
ARROW = " → "
FULL_BLOCK = "█"
LIGHT_BLOCK = "░"


def symbol(label: Column) -> Column:
    """Symbol of a label, with a default for unknown and missing labels."""
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(SYMBOLS.items())])
    return F.coalesce(F.element_at(known, label), F.lit(UNKNOWN_SYMBOL))


def signed(value: Column, places: int = 3) -> Column:
    """Number with its sign and fixed places. An exact tie rounds away from zero."""
    return F.format_string(f"%+.{places}f", value.cast("double"))


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """Percentage as a number; NULL when there is no whole."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, places)


def percent_text(part: Column, whole: Column) -> Column:
    """Percentage as text, such as ``12.5%``."""
    return F.format_string("%.1f%%", percent(part, whole))


def millis_text(seconds: Column, places: int = 1) -> Column:
    """Duration as text, such as ``3.2ms``."""
    return F.format_string(f"%.{places}fms", (seconds * 1000).cast("double"))


def thousands(value: Column) -> Column:
    """Integer with thousands separators."""
    return F.format_number(value, 0)


def progress_bar(done: Column, size: int = 10) -> Column:
    """Filled and open blocks of a batch."""
    return F.concat(F.repeat(F.lit(FULL_BLOCK), done), F.repeat(F.lit(LIGHT_BLOCK), F.lit(size) - done))


def clock(time: Column) -> Column:
    """Time of day as HH:MM:SS."""
    return F.date_format(time, "HH:mm:ss")


def iso_text(time: Column) -> Column:
    """Local ISO time with microseconds and no zone."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def file_stamp(time: Column) -> Column:
    """Time as used in file names."""
    return F.date_format(time, "yyyyMMdd_HHmmss")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with microseconds."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
