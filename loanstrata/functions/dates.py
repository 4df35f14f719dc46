"""Calendar and delinquency date expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_starts(start: date | str, end: date | str) -> list[date]:
    """First days of the months from the month of ``start`` up to ``end``, as job parameters."""
    first, last = (date.fromisoformat(str(d)) for d in (start, end))
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [date(m // 12, m % 12 + 1, 1) for m in months]


def month_calendar(df: DataFrame, column: str) -> DataFrame:
    """One row per month between the first and last date found in ``column``."""
    span = df.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    months = F.sequence(F.trunc("first", "MM"), F.col("last"), F.expr("interval 1 month"))
    return span.select(F.explode(months).alias("snapshot_date"))


def missed_installments(overdue: Column, due: Column) -> Column:
    """Started installments that are overdue, as bigint; NULL if nothing is due."""
    return F.ceil(F.try_divide(overdue, due))


def months_before(day: Column, months: Column) -> Column:
    """The date ``months`` (> 0) months earlier, clamped to the month end; NULL outside the date range."""
    back = F.make_ym_interval(F.lit(0), -months.try_cast("int"))
    return F.when(months > 0, F.try_add(day, back))


def is_past_due(dpd: Column, missed: Column, threshold: int) -> Column:
    """At least ``threshold`` days past due. Where the first missed date lies outside the date range
    the days are unknown, but more than any threshold."""
    return F.coalesce(dpd >= threshold, missed > 0, F.lit(False))


def installment_due_date(loan_start: Column, installment_num: Column) -> Column:
    """Due date of an installment, counted in steps of 30 days."""
    return F.date_add(loan_start, F.try_multiply(installment_num, F.lit(30)))
