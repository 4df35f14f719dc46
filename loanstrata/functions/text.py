"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stand-in for unusable text, the form of a social security number, and the first
# characters of junk categories.
UNKNOWN = "unknown"
SSN_FORM = r"^\d{3}-\d{2}-\d{4}$"
JUNK_MARKS = ["!", "-", "_"]


def normalize_text(c: Column) -> Column:
    """Lower-case with outer spaces removed. Only spaces are trimmed; tabs stay."""
    return F.lower(F.trim(c))


def collapse_spaces(c: Column) -> Column:
    """Turn every run of white space into one space."""
    return F.regexp_replace(c, r"\s+", " ")


def clean_occupation(c: Column) -> Column:
    """Keep ASCII word characters, single underscores inside; nothing left means ``unknown``."""
    words = F.regexp_replace(F.regexp_replace(c, r"\W", ""), "_+", "_")
    return F.coalesce(F.nullif(F.btrim(words, F.lit("_")), F.lit("")), F.lit(UNKNOWN))


def valid_ssn(c: Column) -> Column:
    """A social security number of the form ddd-dd-dddd, otherwise ``unknown``."""
    return F.when(c.rlike(SSN_FORM), c).otherwise(UNKNOWN)


def junk_to_unknown(c: Column) -> Column:
    """Values that are missing or start with ``!``, ``-`` or ``_`` become ``unknown``; ``''`` stays."""
    return F.when(c.isNull() | F.substring(c, 1, 1).isin(JUNK_MARKS), UNKNOWN).otherwise(c)


def loan_types(c: Column) -> Column:
    """Split a list joined by commas and the word "and" into its distinct, trimmed items.

    A separator takes the spaces and further commas around it, so items need no trimming. The lambda keeps
    the projection of the many financial columns out of whole-stage code, whose one method for all of them
    is too large for the JIT; Spark then splits it into small ones. A missing or empty list gives an empty
    array.
    """
    items = F.split(F.trim(F.replace(c, F.lit(" and "), F.lit(","))), " *,[ ,]*")
    return F.coalesce(
        F.filter(F.array_distinct(items), lambda item: item != ""), F.array().cast("array<string>")
    )


def credit_history_years(c: Column) -> Column:
    """``"10 Years and 9 Months"`` → 10.75; a missing part counts as zero.

    Matching ignores case because text is lower-cased before it gets here.
    """

    def part(unit: str) -> Column:
        # fixed value: the form of a duration
        number = F.regexp_extract(c, rf"(?i)(\d+) {unit}", 1)
        return F.coalesce(number.try_cast("double"), F.lit(0.0))

    return part("years") + part("months") / 12.0
