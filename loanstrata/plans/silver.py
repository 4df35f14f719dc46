"""Silver: normalised, deduplicated, typed rows. Each cleaner handles all snapshots at once."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanstrata.functions.dates import missed_installments, months_before
from loanstrata.functions.numbers import in_age_range, strict_int, to_integer, to_number
from loanstrata.functions.text import (
    clean_occupation,
    collapse_spaces,
    credit_history_years,
    junk_to_unknown,
    loan_types,
    valid_ssn,
)
from loanstrata.operators.dedup import keep_one
from loanstrata.operators.normalize import normal_name, normalize_names, normalize_strings, quoted
from loanstrata.schemas import (
    FINANCIAL_INTEGERS,
    FINANCIAL_NUMBERS,
    KEYS,
    LMS_TYPES,
    SNAPSHOT,
    source,
)

DEFAULT_AGE = 30.0


def normalize(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Normal column names, trimmed lower-case text, one row per customer and snapshot.

    A table without the key columns is not deduplicated.
    """
    rows = normalize_strings(normalize_names(df))
    return keep_one(rows, keys) if set(keys) <= set(rows.columns) else rows


def _convert(df: DataFrame, conversions: dict[str, Column]) -> DataFrame:
    """Apply the conversions whose column exists, in one projection."""
    return df.withColumns({name: c for name, c in conversions.items() if name in df.columns})


def _typed(name: str, dtype: str) -> Column:
    return strict_int(F.col(name)) if dtype == "int" else F.col(name).try_cast(dtype)


def clean_lms(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Typed loan rows with months on book, missed installments, first missed date, days past due.

    ``keys`` defaults to one row per customer and snapshot; a customer with two loans in a month
    keeps one of them. Pass the loan as a key, too, to keep every loan. Missing numbers become 0.
    With an overdue amount but nothing due, the days past due are unknown (NULL), as they are when the
    first missed date lies outside the date range; the count of missed installments tells them apart.
    """
    rows = _convert(normalize(df, keys), {n: _typed(n, t) for n, t in LMS_TYPES.items()})
    missed = missed_installments(F.col("overdue_amt"), F.col("due_amt"))
    rows = rows.withColumns({"mob": F.col("installment_num"), "installments_missed": missed})
    numbers = [n for n, t in LMS_TYPES.items() if t in ("int", "double") and n in rows.columns]
    rows = rows.fillna(0, subset=[*numbers, "mob", "installments_missed"])
    rows = rows.withColumn(
        "first_missed_date", months_before(F.col(SNAPSHOT), F.col("installments_missed"))
    )
    days = F.datediff(SNAPSHOT, "first_missed_date")
    return rows.withColumn("dpd", F.when(F.col("overdue_amt") > 0, days).otherwise(0))


def clean_clickstream(df: DataFrame) -> DataFrame:
    """All ``fe_*`` columns as double, NULL where unreadable."""
    rows = normalize(df)
    return _convert(
        rows, {c: F.col(c).try_cast("double") for c in rows.columns if c.startswith("fe_")}
    )


def repair_age(df: DataFrame) -> DataFrame:
    """Replace ages outside 1 to 120 by the median of the valid ages of the same snapshot.

    Digits before the first point count, so ``28_`` and ``28.0`` are 28 and ``-30`` is 30. Without
    any valid age in a snapshot the default is 30. The result is always double.
    """
    rows = df.withColumn("age", in_age_range(to_integer(F.col("age"))))
    # At most 120 distinct ages per snapshot reach the exact median, and one row per snapshot
    # date leaves it: the broadcast side cannot grow with the data.
    medians = rows.groupBy(SNAPSHOT).agg(F.percentile("age", F.lit(0.5)).alias("median_age"))
    joined = rows.join(F.broadcast(medians), SNAPSHOT, "left")
    age = F.coalesce(F.col("age").cast("double"), "median_age", F.lit(DEFAULT_AGE))
    return joined.withColumn("age", age).select(quoted(df.columns))


def clean_attributes(df: DataFrame) -> DataFrame:
    """Repaired age, occupation, name and social security number."""
    rows = normalize(df)
    if "age" in rows.columns:
        rows = repair_age(rows)
    return _convert(
        rows,
        {
            "occupation": clean_occupation(F.col("occupation")),
            "name": collapse_spaces(F.col("name")),
            "ssn": valid_ssn(F.col("ssn")),
        },
    )


def clean_financials(df: DataFrame) -> DataFrame:
    """Repaired numbers, categories, credit history in years, loan list and its length.

    A ``num_of_loan`` in the input is replaced by the number of distinct loan types.
    """
    rows = _convert(
        normalize(df),
        {
            **{n: to_number(F.col(n)) for n in FINANCIAL_NUMBERS},
            **{n: to_integer(F.col(n)) for n in FINANCIAL_INTEGERS},
            "payment_behaviour": junk_to_unknown(F.col("payment_behaviour")),
            "credit_mix": junk_to_unknown(F.col("credit_mix")),
            "credit_history_age": credit_history_years(F.col("credit_history_age")),
            "type_of_loan": loan_types(F.col("type_of_loan")),
        },
    )
    if "type_of_loan" not in rows.columns:
        return rows
    return rows.withColumns(
        {
            "num_of_loan": F.size("type_of_loan"),
            "type_of_loan": F.array_join("type_of_loan", ", "),
        }
    )


CLEANERS = {
    "lms": clean_lms,
    "clickstream": clean_clickstream,
    "attributes": clean_attributes,
    "financials": clean_financials,
}


def leading(df: DataFrame, needed: Collection[str]) -> DataFrame:
    """The keys, and the columns up to the last one of ``needed``, by their normal names; two columns at least.

    Of several rows of a key the smallest is kept, compared column by column: the columns that follow
    decide between rows that are equal in these, and so change nothing of what is needed. One column
    alone would be compared otherwise, for its smallest value is none that is NULL.
    """
    rest = [c for c in df.columns if normal_name(c) not in KEYS]
    last = max((i for i, c in enumerate(rest) if normal_name(c) in needed), default=len(rest) - 1)
    later = rest[max(last, 1) + 1 :]
    return df.select(quoted([c for c in df.columns if c not in later]))


def clean(name: str, bronze: DataFrame, needed: Collection[str] = ()) -> DataFrame:
    """Clean the bronze rows of a source by its name: all columns, or those up to the last one ``needed``."""
    return CLEANERS[source(name).name](leading(bronze, needed) if needed else bronze)
