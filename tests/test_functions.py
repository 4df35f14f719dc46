"""Column functions on the edge rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from loanstrata.functions import dates, numbers, text


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def check(spark, function, cases):
    assert apply(spark, function, [value for value, _ in cases]) == [want for _, want in cases]


def test_normalize_text_trims_spaces_only(spark):
    check(spark, text.normalize_text, [("  MiXed ", "mixed"), ("\t a ", "\t a"), (None, None), ("", "")])


def test_collapse_spaces(spark):
    check(spark, text.collapse_spaces, [("a  b\t\nc", "a b c"), (None, None)])


def test_clean_occupation(spark):
    cases = [
        ("__media manager__x", "mediamanager_x"),
        ("", "unknown"),
        (None, "unknown"),
        ("___", "unknown"),
        ("café", "caf"),
        ("a__b_c_", "a_b_c"),
        ("_!_", "unknown"),
    ]
    check(spark, text.clean_occupation, cases)


def test_valid_ssn(spark):
    cases = [("821-00-0265", "821-00-0265"), ("#f%$d@*&8", "unknown"), (None, "unknown")]
    check(spark, text.valid_ssn, [*cases, ("821-00-02650", "unknown")])


def test_junk_to_unknown(spark):
    cases = [("!@9#%8", "unknown"), ("_______", "unknown"), ("-x", "unknown"), (None, "unknown")]
    check(spark, text.junk_to_unknown, [*cases, ("", ""), ("good", "good"), ("a-b", "a-b")])


def test_to_number(spark):
    cases = [
        (None, 0.0),
        ("", 0.0),
        ("_", 0.0),
        ("0", 0.0),
        ("0.0", 0.0),
        ("15000000.0_", 15000000.0),
        ("1.2.3", 1.2),
        ("5.", 5.0),
        (".5", 0.5),
        ("12-34", 12.0),
        ("--5", -5.0),
        ("-", 0.0),
        ("1.5e7", 15000000.0),
        ("1.0e-4", 0.0001),
        ("__-333333333333333333333333333__", -333333333333333333333333333.0),
        ("nan", 0.0),
        ("5d", 5.0),
        ("infinity", 0.0),
    ]
    check(spark, numbers.to_number, cases)


def test_to_integer(spark):
    cases = [
        (None, 0),
        ("", 0),
        ("0", 0),
        ("_", 0),
        ("3_", 3),
        ("-1", 1),
        ("3.0", 3),
        (".5", 0),
        ("99999999999", None),
        ("2147483647", 2147483647),
        ("2147483648", None),
    ]
    check(spark, numbers.to_integer, cases)


def test_strict_int(spark):
    cases = [("10", 10), ("10.0", 10), ("x", None), (None, None), ("99999999999", None)]
    check(spark, numbers.strict_int, cases)


def test_age_range_and_band(spark):
    ages = [("1", 1), ("120", 120), ("0", None), ("121", None), (None, None)]
    check(spark, lambda c: numbers.in_age_range(c.try_cast("int")), ages)
    bands = [
        ("24.5", "other"),
        ("34", "25-34"),
        ("13", "other"),
        ("14", "14-24"),
        ("44", "35-44"),
        ("45", "45-56"),
        ("57", "other"),
        (None, "other"),
    ]
    check(spark, lambda c: numbers.age_band(c.try_cast("double")), bands)


def test_safe_ratio(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0), (1.0, 0.0), (1.0, -1.0), (1.0, None), (None, 2.0)], "n double, d double"
    )
    got = [r[0] for r in rows.select(numbers.safe_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [0.5, None, None, None, None]


def test_row_mean_is_null_if_any_part_is(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in rows.select(numbers.row_mean([F.col("a"), F.col("b")])).collect()]
    assert got == [1.5, None]


def test_credit_history_years(spark):
    cases = [
        ("10 years and 9 months", 10.75),
        ("10 Years and 9 Months", 10.75),
        ("6 months", 0.5),
        ("na", 0.0),
        (None, 0.0),
    ]
    check(spark, text.credit_history_years, cases)


def test_loan_types(spark):
    cases = [
        (
            "auto loan, credit-builder loan, and home equity loan",
            ["auto loan", "credit-builder loan", "home equity loan"],
        ),
        ("auto loan and auto loan,not specified", ["auto loan", "not specified"]),
        (",,a, ,b,", ["a", "b"]),
        ("a,  and  b", ["a", "b"]),
        ("brand andy", ["brand andy"]),
        (" , ", []),
        ("", []),
        (None, []),
    ]
    check(spark, text.loan_types, cases)


def test_months_before_clamps_and_guards(spark):
    rows = spark.createDataFrame(
        [(date(2023, 3, 31), 1), (date(2023, 3, 1), 0), (date(2023, 3, 1), 2_000_000_000)],
        "d date, n int",
    )
    got = [r[0] for r in rows.select(dates.months_before(F.col("d"), F.col("n"))).collect()]
    assert got == [date(2023, 2, 28), None, None]


def test_month_starts():
    assert dates.month_starts("2023-11-15", "2024-01-01") == [
        date(2023, 11, 1),
        date(2023, 12, 1),
        date(2024, 1, 1),
    ]
    assert dates.month_starts("2024-02-01", "2024-01-01") == []
    assert len(dates.month_starts("2023-01-01", "2024-12-01")) == 24


@pytest.mark.parametrize("last, months", [("2023-02-27", 2), ("2023-03-01", 3)])
def test_month_calendar(spark, last, months):
    df = spark.createDataFrame([("2023-01-15",), (last,)], "d string").select(F.to_date("d").alias("d"))
    got = [r[0] for r in dates.month_calendar(df, "d").orderBy("snapshot_date").collect()]
    assert got == [date(2023, m, 1) for m in range(1, months + 1)]
