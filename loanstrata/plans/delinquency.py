"""Delinquency analysis of the silver loan table: bad rates, last observations, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.functions.dates import is_past_due
from loanstrata.operators.dedup import latest
from loanstrata.operators.distribution import equal_width_histogram, exceedance

# The days-past-due thresholds of the two reports.
DPD_THRESHOLDS = [1, 5, 10, 15, 20, 30, 60, 90]
DEFAULT_THRESHOLDS = [20, 30, 60, 90]
DEFAULT_MOB = 6


def observations(lms: DataFrame, dpd: int = 30, started_before: str = "2024-01-01") -> DataFrame:
    """Loans started before a date, with ``dpd_flag`` = 1 from ``dpd`` days past due on."""
    started = F.col("loan_start_date") < F.lit(started_before).cast("date")
    bad = is_past_due(F.col("dpd"), F.col("installments_missed"), dpd)
    return lms.where(started).withColumn("dpd_flag", bad.cast("int"))


def mob_profile(obs: DataFrame) -> DataFrame:
    """Observations, bad rate and mean days past due by month on book, in one pass."""
    return obs.groupBy("mob").agg(
        F.count("*").alias("n_obs"),
        F.avg("dpd_flag").alias("bad_rate"),
        F.avg("dpd").alias("avg_dpd"),
    )


def bad_rate_by_mob(obs: DataFrame) -> DataFrame:
    """Bad-rate curve over months on book."""
    return mob_profile(obs).select("mob", "bad_rate").orderBy("mob")


def mob_counts(obs: DataFrame) -> DataFrame:
    """Number of observations by month on book."""
    return mob_profile(obs).select("mob", "n_obs").orderBy("mob")


def dpd_by_mob(obs: DataFrame) -> DataFrame:
    """Mean days past due by month on book."""
    return mob_profile(obs).select("mob", "avg_dpd").orderBy("mob")


def at_installment(obs: DataFrame, installment: int = 10) -> DataFrame:
    """Observations of one installment, by default the final one of a ten-month loan."""
    return obs.where(F.col("installment_num") == installment)


def last_observation(obs: DataFrame) -> DataFrame:
    """The observation with the highest installment number of each loan.

    Of several with that number the one of the latest snapshot counts, then a bad one.
    """
    return latest(obs, ["loan_id"], "installment_num", "snapshot_date", "dpd_flag")


def actual_bads(obs: DataFrame) -> DataFrame:
    """Loans that are bad at their last observation."""
    return last_observation(obs).where(F.col("dpd_flag") == 1)


def actual_bads_summary(obs: DataFrame) -> DataFrame:
    """Number of loans, and of loans bad at their last observation.

    Only the columns that decide about the last flag are shuffled.
    """
    flags = obs.select("loan_id", "installment_num", "snapshot_date", "dpd_flag")
    return last_observation(flags).agg(
        F.count("*").alias("n_loans"), F.count_if(F.col("dpd_flag") == 1).alias("n_bad_loans")
    )


def dpd_histogram(obs: DataFrame, bins: int = 50, at_most: int | None = None) -> DataFrame:
    """Equal-width histogram of days past due, optionally only of values up to ``at_most``."""
    if at_most is not None:
        obs = obs.where(F.col("dpd") <= at_most)
    return equal_width_histogram(obs, "dpd", bins)


def dpd_thresholds(obs: DataFrame, thresholds: list[int] = DPD_THRESHOLDS) -> DataFrame:
    """Share of observations at or above each days-past-due threshold."""
    return exceedance(obs, "dpd", thresholds)


def default_split(
    obs: DataFrame, mob: int = 6, thresholds: list[int] = DEFAULT_THRESHOLDS
) -> DataFrame:
    """Default and non-default observations at ``mob`` months on book, by threshold."""
    return exceedance(obs.where(F.col("mob") == mob), "dpd", thresholds).select(
        "threshold",
        F.col("n_below").alias("n_non_default"),
        F.col("n_at_or_above").alias("n_default"),
        F.col("pct_at_or_above").alias("default_rate_pct"),
    )


def summary(obs: DataFrame) -> DataFrame:
    """Size, number of loans, ranges of month on book and days past due, overall bad rate."""
    return obs.agg(
        F.count("*").alias("n_obs"),
        F.count_distinct("loan_id").alias("n_loans"),
        F.min("mob").alias("min_mob"),
        F.max("mob").alias("max_mob"),
        F.min("dpd").alias("min_dpd"),
        F.max("dpd").alias("max_dpd"),
        F.avg("dpd_flag").alias("bad_rate"),
    )


def tables(lms: DataFrame, dpd: int = 30, mob: int = 6, started_before: str = "2024-01-01") -> dict[str, DataFrame]:
    """All tables of the analysis, by name."""
    obs = observations(lms, dpd, started_before)
    return {
        "mob_profile": mob_profile(obs),
        "bad_rate_by_mob": bad_rate_by_mob(obs),
        "mob_counts": mob_counts(obs),
        "dpd_by_mob": dpd_by_mob(obs),
        "final_installment": at_installment(obs),
        "actual_bads": actual_bads(obs),
        "actual_bads_summary": actual_bads_summary(obs),
        "dpd_histogram": dpd_histogram(obs),
        "dpd_histogram_60": dpd_histogram(obs, bins=30, at_most=60),
        "dpd_thresholds": dpd_thresholds(obs),
        "default_split": default_split(obs, mob),
        "summary": summary(obs),
    }
