"""Scalar text functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = "[A-Za-z']+"

# Unicode white space, and the four separators that only a Python strip removes.
_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def tokens(text: Column) -> Column:
    """ASCII word tokens in their original case; lower-case them afterwards."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends, in one step from each."""
    return F.btrim(text, F.lit(_SPACE))


def clip(text: Column, chars: int) -> Column:
    """The first ``chars`` characters, with dots only when something was cut."""
    return F.concat(F.substring(text, 1, chars), F.when(F.length(text) > chars, "...").otherwise(""))


def clip_always(text: Column, chars: int) -> Column:
    """The first ``chars`` characters, always with dots."""
    return F.concat(F.substring(text, 1, chars), F.lit("..."))


def non_empty(text: Column) -> Column:
    """NULL in place of an empty string."""
    return F.nullif(text, F.lit(""))


def once(value: Column, describe: Callable[[Column], Column]) -> Column:
    """``describe(value)`` with both evaluated once per row; for ``select`` only.

    Filters on a costly column are otherwise pushed below its projection, where they
    evaluate it again. They are not pushed below a generator, and this one gives
    exactly one row per row.
    """
    return F.explode_outer(F.transform(F.array(value), describe))
