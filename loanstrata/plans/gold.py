"""Gold: the label store and the feature store.

Every feature source has two parts: the row-level expressions (``feature_rows``) and the aggregates
that reduce them to one row per customer and snapshot (``_summary``). The features of one source
apply both to that source; the feature store applies all aggregates at once to the union of the
sources' rows, so every source is shuffled once and nothing is joined.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanstrata.functions.dates import installment_due_date, is_past_due, missed_installments
from loanstrata.functions.numbers import age_band, row_mean, safe_ratio
from loanstrata.operators.dedup import latest
from loanstrata.operators.merge import audit_counts, row_counts, sources_present, union_sources
from loanstrata.schemas import (
    ALL_SOURCES_MASK,
    CUSTOMER,
    FEATURE_STORE,
    FEATURES,
    KEYS,
    LABEL_STORE,
    OPTIONAL,
    SNAPSHOT,
    SOURCE_COLUMNS,
    SOURCES,
)


def label_store(lms: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """One row per loan at ``mob`` months on book: 1 if at least ``dpd`` days past due, else 0.

    With an overdue amount but nothing due the label is 0.
    """
    labels = {
        "label": is_past_due(F.col("dpd"), F.col("installments_missed"), dpd).cast("int"),
        # fixed value: the form of the label's definition
        "label_def": F.lit(f"{dpd}dpd_{mob}mob"),
    }
    return lms.where(F.col("mob") == mob).withColumns(labels).select(*LABEL_STORE)


def latest_records(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Each customer's latest row, of all snapshots or of those up to ``as_of``."""
    if as_of is not None:
        df = df.where(F.col(SNAPSHOT) <= F.lit(as_of).cast("date"))
    return latest(df, [CUSTOMER], SNAPSHOT)


def _feature_columns(clickstream: DataFrame) -> list[str]:
    return [c for c in clickstream.columns if c.startswith("fe_")]


def _clickstream_rows(df: DataFrame) -> DataFrame:
    """Mean of the ``fe_*`` columns that the row's raw file had: NULL if one of them is NULL.

    A table from the lake names these columns; other tables have the same ones in every row. Rows of
    a file without any are left out, as if the source had no row there.
    """
    columns = _feature_columns(df)
    if not columns:
        raise ValueError("clickstream has no fe_* columns")
    if SOURCE_COLUMNS not in df.columns:
        return df.select(*KEYS, row_mean([F.col(c) for c in columns]).alias("total_mean"))
    listed = F.split(SOURCE_COLUMNS, ",")
    had = {c: F.array_contains(listed, c) for c in columns}
    total = reduce(add, [F.when(had[c], F.col(c)).otherwise(0.0) for c in columns])
    n = reduce(add, [had[c].cast("int") for c in columns])
    return df.where(n > 0).select(*KEYS, F.try_divide(total, n).alias("total_mean"))


def _attributes_rows(df: DataFrame) -> DataFrame:
    profile = F.struct(age_band(F.col("age")).alias("age_group"), "occupation")
    return df.select(*KEYS, profile.alias("profile"))


def _financials_rows(df: DataFrame) -> DataFrame:
    balance = F.col("monthly_balance").try_cast("double")
    ratios = F.struct(
        safe_ratio(F.col("outstanding_debt"), F.col("annual_income")).alias("debt_to_income"),
        safe_ratio(F.col("total_emi_per_month"), F.col("monthly_inhand_salary")).alias("emi_to_salary"),
        safe_ratio(balance, F.col("outstanding_debt")).alias("balance_to_debt"),
        "credit_history_age",
    )
    return df.select(*KEYS, ratios.alias("ratios"))


def _lms_rows(df: DataFrame, mob: int) -> DataFrame:
    """Loan rows at ``mob`` months on book.

    The days past due here count from the due date of the installment (30 days each), unlike those
    of the silver table and the label, which go back whole months from the snapshot.
    """
    overdue, due = F.col("overdue_amt"), F.col("due_amt")
    missed = F.when(due > 0, missed_installments(overdue, due)).otherwise(0)
    first = F.when(
        missed > 0, installment_due_date(F.col("loan_start_date"), F.col("installment_num"))
    )
    return (
        df.where(F.col("mob") == mob)
        .select(*KEYS, "mob", missed.alias("installments_missed"), first.alias("first_missed_date"))
        .withColumn("dpd", F.coalesce(F.datediff(SNAPSHOT, "first_missed_date"), F.lit(0)))
    )


def feature_rows(name: str, silver: DataFrame, mob: int = 6) -> DataFrame:
    """Row-level features of a source: its keys and the inputs of its aggregates."""
    if name == "lms":
        return _lms_rows(silver, mob)
    rows = {
        "clickstream": _clickstream_rows,
        "attributes": _attributes_rows,
        "financials": _financials_rows,
    }
    return rows[name](silver)


def _summary(name: str) -> list[Column]:
    """Aggregates over ``feature_rows``; silver has one row per key, so the choice only guards that."""
    if name == "clickstream":
        return [F.avg("total_mean").alias("clickstream_total_mean")]
    if name == "attributes":
        return [F.min("profile").getField(c).alias(c) for c in FEATURES[name]]
    if name == "financials":
        return [F.min("ratios").getField(c).alias(c) for c in FEATURES[name]]
    averages = [F.avg(c).alias(c) for c in ("mob", "installments_missed", "dpd")]
    return [*averages, F.min("first_missed_date").alias("first_missed_date")]


def features(name: str, silver: DataFrame, mob: int = 6) -> DataFrame:
    """Features of one source, one row per customer and snapshot."""
    rows = feature_rows(name, silver, mob).groupBy(*KEYS).agg(*_summary(name))
    return rows.select(*KEYS, *FEATURES[name])


def rows_by_source(silver: dict[str, DataFrame | None], mob: int = 6) -> dict[str, DataFrame]:
    """Row-level features of the sources there are, without a clickstream that has no ``fe_*`` columns."""
    return {
        name: feature_rows(name, silver[name], mob)
        for name in SOURCES
        if silver.get(name) is not None and (name != "clickstream" or _feature_columns(silver[name]))
    }


def feature_store(
    silver: dict[str, DataFrame | None], mob: int = 6, on_missing: str = "skip"
) -> DataFrame:
    """Customers found in every required source of their snapshot, with the features of all four.

    With ``on_missing="skip"`` a source that is absent from ``silver`` is not required, nor is
    clickstream without ``fe_*`` columns. Clickstream and loans are not required in a snapshot where
    they have no row (for loans: none at ``mob``); attributes and financials always are, so a
    snapshot without them has no rows. Columns of a source that is left out are NULL. With
    ``"strict"`` all four sources are required.
    """
    _check(on_missing)
    rows = rows_by_source(silver, mob)
    if not rows:
        raise ValueError("no source to build features from")
    # Not a filter on the key: pushed below the deduplication of the sources, it would make their shuffles
    # others than those that the medians and the presence mask read, and these would run again.
    known = F.bool_or(F.col(CUSTOMER).isNotNull()).alias("known")
    merged = (
        union_sources(rows)
        .groupBy(*KEYS)
        .agg(known, F.bit_or("mask").alias("mask"), *[c for name in rows for c in _summary(name)])
        .where("known")
    )
    optional = {name: rows[name] for name in rows if name in OPTIONAL}
    present = sources_present(optional) if optional and on_missing == "skip" else None
    return _complete(merged, list(rows), on_missing, present)


def customer_rows(rows: dict[str, DataFrame]) -> DataFrame:
    """What all sources have of each customer and snapshot: the mask of those that have a row, the number
    of rows of each, and all features. `store_of` and `audit_of` need no more shuffle by customer."""
    features = [c for name in rows for c in _summary(name)]
    mask = F.bit_or("mask").alias("mask")
    return union_sources(rows).groupBy(*KEYS).agg(mask, *row_counts(list(rows)), *features)


def _present(together: DataFrame, names: list[str]) -> DataFrame | None:
    """The optional sources that each snapshot has, from `customer_rows`: one row per snapshot."""
    optional = sum(SOURCES[name].bit for name in names if name in OPTIONAL)
    if not optional:
        return None
    seen = F.bit_or("mask").bitwiseAND(F.lit(optional))
    return together.groupBy(SNAPSHOT).agg(seen.alias("present"))


def store_of(together: DataFrame, names: list[str], on_missing: str = "skip") -> DataFrame:
    """The feature store from `customer_rows` of the sources ``names``, see `feature_store`."""
    _check(on_missing)
    present = _present(together, names) if on_missing == "skip" else None
    return _complete(together.where(F.col(CUSTOMER).isNotNull()), names, on_missing, present)


def audit_of(together: DataFrame, names: list[str], on_missing: str = "skip") -> DataFrame:
    """The join audit from `customer_rows` of the sources ``names``, see `join_audit`."""
    _check(on_missing)
    counts = together.select(*KEYS, *[f"n_{name}" for name in names])
    return audit_counts(counts, names, _present(together, names) if on_missing == "skip" else None)


def _check(on_missing: str) -> None:
    if on_missing not in ("skip", "strict"):
        raise ValueError(f"on_missing must be 'skip' or 'strict', not {on_missing!r}")


def _complete(merged: DataFrame, names: list[str], on_missing: str, present: DataFrame | None) -> DataFrame:
    """Customers whose mask has all required sources, with the columns of the store."""
    if on_missing == "strict":
        kept = merged.where(F.col("mask") == ALL_SOURCES_MASK)
    else:
        required = F.lit(sum(SOURCES[name].bit for name in names if name not in OPTIONAL))
        if present is not None:
            # One row per snapshot date: the broadcast side cannot grow with the data.
            merged = merged.join(F.broadcast(present), SNAPSHOT, "left")
            required = F.coalesce("present", F.lit(0)).bitwiseOR(required)
        kept = merged.where(F.col("mask") == required)
    return kept.select(
        *[
            F.col(c) if c in merged.columns else F.lit(None).cast(dtype).alias(c)
            for c, dtype in FEATURE_STORE.items()
        ]
    )
