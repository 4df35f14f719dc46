"""Delinquency counts from an additive cube of the loan table, and the last observation of each loan as a state.

The cube holds how many observations each snapshot has by start of the loan, month on book, days past due,
and whether an installment is missed. Its size is bounded by the values of these, not by the number of
loans, and cubes of different snapshots add up: so a new month is counted once, and every table of counts,
for any threshold and any start of the loans, is an aggregate over the cube.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.functions.dates import is_past_due
from loanstrata.operators.distribution import equal_width_histogram, exceedance
from loanstrata.plans.delinquency import DEFAULT_THRESHOLDS, DPD_THRESHOLDS, last_observation
from loanstrata.schemas import LOAN_CUBE


def loan_cube(lms: DataFrame) -> DataFrame:
    """Number of observations by snapshot, start of the loan, month on book, days past due, missed or not."""
    missed = F.coalesce(F.col("installments_missed") > 0, F.lit(False))
    cells = lms.select("snapshot_date", "loan_start_date", "mob", "dpd", missed.alias("missed"))
    return cells.groupBy(*cells.columns).agg(F.count("*").alias("n")).select(*LOAN_CUBE)


def cells(cube: DataFrame, dpd: int = 30, started_before: str = "2024-01-01") -> DataFrame:
    """Cells of loans started before a date, with ``dpd_flag`` = 1 from ``dpd`` days past due on."""
    started = F.col("loan_start_date") < F.lit(started_before).cast("date")
    bad = is_past_due(F.col("dpd"), F.col("missed").cast("int"), dpd)
    return cube.where(started).withColumn("dpd_flag", bad.cast("int"))


def mob_profile(cells: DataFrame) -> DataFrame:
    """Observations, bad rate and mean days past due by month on book."""
    known = F.sum(F.when(F.col("dpd").isNotNull(), F.col("n")))
    return cells.groupBy("mob").agg(
        F.sum("n").alias("n_obs"),
        F.try_divide(F.sum(F.col("dpd_flag") * F.col("n")), F.sum("n")).alias("bad_rate"),
        F.try_divide(F.sum(F.col("dpd") * F.col("n")), known).alias("avg_dpd"),
    )


def dpd_histogram(cells: DataFrame, bins: int = 50, at_most: int | None = None) -> DataFrame:
    """Equal-width histogram of days past due, optionally only of values up to ``at_most``."""
    if at_most is not None:
        cells = cells.where(F.col("dpd") <= at_most)
    return equal_width_histogram(cells, "dpd", bins, weight="n")


def dpd_thresholds(cells: DataFrame, thresholds: list[int] = DPD_THRESHOLDS) -> DataFrame:
    """Share of observations at or above each days-past-due threshold."""
    return exceedance(cells, "dpd", thresholds, weight="n")


def default_split(cells: DataFrame, mob: int = 6, thresholds: list[int] = DEFAULT_THRESHOLDS) -> DataFrame:
    """Default and non-default observations at ``mob`` months on book, by threshold."""
    return exceedance(cells.where(F.col("mob") == mob), "dpd", thresholds, weight="n").select(
        "threshold",
        F.col("n_below").alias("n_non_default"),
        F.col("n_at_or_above").alias("n_default"),
        F.col("pct_at_or_above").alias("default_rate_pct"),
    )


def summary(cells: DataFrame, last: DataFrame) -> DataFrame:
    """Size, number of loans, ranges of month on book and days past due, overall bad rate.

    ``last`` has one row per loan, so it counts the loans.
    """
    counted = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_obs"),
        F.min("mob").alias("min_mob"),
        F.max("mob").alias("max_mob"),
        F.min("dpd").alias("min_dpd"),
        F.max("dpd").alias("max_dpd"),
        F.try_divide(F.sum(F.col("dpd_flag") * F.col("n")), F.sum("n")).alias("bad_rate"),
    )
    loans = last.agg(F.count("loan_id").alias("n_loans"))
    columns = ["n_obs", loans.scalar().alias("n_loans"), "min_mob", "max_mob", "min_dpd", "max_dpd", "bad_rate"]
    return counted.select(*columns)


def count_tables(cells: DataFrame, last: DataFrame, mob: int = 6) -> dict[str, DataFrame]:
    """All tables of counts, by the names they have when they are made from the loan table itself."""
    profile = mob_profile(cells)
    return {
        "mob_profile": profile,
        "bad_rate_by_mob": profile.select("mob", "bad_rate").orderBy("mob"),
        "mob_counts": profile.select("mob", "n_obs").orderBy("mob"),
        "dpd_by_mob": profile.select("mob", "avg_dpd").orderBy("mob"),
        "dpd_histogram": dpd_histogram(cells),
        "dpd_histogram_60": dpd_histogram(cells, bins=30, at_most=60),
        "dpd_thresholds": dpd_thresholds(cells),
        "default_split": default_split(cells, mob),
        "summary": summary(cells, last),
    }


def merged_last(state: DataFrame | None, new: DataFrame) -> DataFrame:
    """The last observation of each loan, from a state of earlier snapshots and the observations of others.

    The state takes part as the observations it holds: the last one of all is the last of the last ones.
    """
    if state is None:
        return last_observation(new)
    both = new.unionByName(state, allowMissingColumns=True)
    order = [*new.columns, *[c for c in state.columns if c not in new.columns]]
    return last_observation(both.select(*order))


def bads_summary(last: DataFrame) -> DataFrame:
    """Number of loans, and of loans bad at their last observation."""
    return last.agg(F.count("*").alias("n_loans"), F.count_if(F.col("dpd_flag") == 1).alias("n_bad_loans"))
