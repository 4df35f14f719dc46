"""Equal-width histograms and threshold tables over one integer column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equal_width_histogram(df: DataFrame, column: str, bins: int, weight: str | None = None) -> DataFrame:
    """Counts in ``bins`` equal bins between the smallest and the largest value, last bin closed.

    Values are counted first; range and bins both come from the counts, so the table is read once. With
    a ``weight`` column every row counts that many times.
    A value on a bin edge falls into the bin that starts there. When all values are equal the range
    is one unit around them.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("bigint").alias("value"))
        .agg(F.sum(weight).alias("n") if weight else F.count("*").alias("n"))
    )
    # The count goes along with the extreme values: without it the optimizer would take them from
    # the table in a second scan instead of from the shuffled counts.
    counted = F.struct("value", "n")
    span = counts.agg(F.min(counted).alias("low"), F.max(counted).alias("high"))
    span = span.select("low.value", "high.value").toDF("low", "high")
    # Twice the bounds keeps the half units of a one-value range whole.
    one = F.col("low") == F.col("high")
    range2 = span.select(
        (2 * F.col("low") - F.when(one, 1).otherwise(0)).alias("low"),
        F.when(one, 2).otherwise(2 * (F.col("high") - F.col("low"))).alias("width"),
    )
    low, width = (range2.select(c).scalar() for c in ("low", "width"))
    position = F.floor((2 * F.col("value") - low) * bins / width)
    binned = counts.groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.sum("n").alias("n_obs")
    )
    start, step = low / F.lit(2.0), width / F.lit(2.0 * bins)
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(binned, "bin", "left").select(
        "bin",
        (start + F.col("bin") * step).alias("bin_start"),
        (start + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("n_obs", F.lit(0)).alias("n_obs"),
    )


def exceedance(
    df: DataFrame, column: str, thresholds: list[int], name: str = "threshold", weight: str | None = None
) -> DataFrame:
    """For each threshold: all rows, rows at or above it, rows below it, and the share above.

    With a ``weight`` column every row counts that many times.
    """
    total = F.col("n_obs")

    def count(condition: Column) -> Column:
        if weight is None:
            return F.count_if(condition)
        return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0))

    counted = df.agg(
        count(F.lit(True)).alias("n_obs"),
        *[count(F.col(column) >= t).alias(f"at_{t}") for t in thresholds],
    )

    def line(t: int) -> Column:
        above = F.col(f"at_{t}")
        return F.struct(
            F.lit(t).alias(name),
            total.alias("n_obs"),
            above.alias("n_at_or_above"),
            (total - above).alias("n_below"),
            F.try_divide(above * F.lit(100.0), total).alias("pct_at_or_above"),
        )

    return counted.select(F.inline(F.array(*[line(t) for t in thresholds])))
