"""Number repair, ratios and bands. Conversions never raise: what cannot be read becomes NULL or 0."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number as a whole cell, and the first one inside a cell.
WELL_FORMED = r"^-?\d*\.?\d+([eE][+-]?\d+)?$"
FIRST_NUMBER = r"-?\d*\.?\d+"


def to_number(c: Column) -> Column:
    """Dirty numeric text → double; missing, blank and unreadable text → 0.0.

    Well-formed text (also with an exponent, so 1.5e7 stays 15000000) is cast at once. Other text
    loses all but digits, points and minus signs, and the first number in the rest counts:
    ``1.2.3`` → 1.2, ``12-34`` → 12, ``--5`` → -5.
    """
    # fixed value: the characters that a number is made of
    stripped = F.regexp_replace(c, r"[^\d.\-]", "")
    text = F.when(c.rlike(WELL_FORMED), c).otherwise(F.regexp_extract(stripped, FIRST_NUMBER, 0))
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def to_integer(c: Column) -> Column:
    """Dirty integer text → int without sign; missing or blank → 0, beyond the int range → NULL.

    Digits before the first point count: ``3_`` → 3, ``-1`` → 1, ``3.0`` → 3. The leading "0"
    turns "no digits" into 0 and leaves every other value alone.
    """
    # fixed value: the characters that an integer is made of
    digits = F.substring_index(F.regexp_replace(c, r"[^\d.]", ""), ".", 1)
    return F.concat(F.lit("0"), F.coalesce(digits, F.lit(""))).try_cast("int")


def strict_int(c: Column) -> Column:
    """Numeric text → int, fraction cut off, NULL when unreadable or out of range."""
    return c.try_cast("double").try_cast("int")


def in_age_range(age: Column) -> Column:
    """An age between 1 and 120, otherwise NULL."""
    return F.when(age.between(1, 120), age)


def age_band(age: Column) -> Column:
    """Age group label. Both bounds are closed, so 24.5 falls between two bands: ``other``."""
    # The age bands.
    bands = [(14, 24), (25, 34), (35, 44), (45, 56)]
    return F.coalesce(
        *[F.when(age.between(low, high), F.lit(f"{low}-{high}")) for low, high in bands],
        F.lit("other"),
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator for a positive denominator, otherwise NULL."""
    return F.when(denominator > 0, numerator / denominator)


def row_mean(columns: list[Column]) -> Column:
    """Mean across the columns of one row; NULL if any of them is NULL."""
    return reduce(add, columns) / F.lit(len(columns))
