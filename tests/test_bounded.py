"""What a task holds, and how many tasks share the work, however large the tables are."""

from __future__ import annotations

from collections import Counter
from datetime import date, timedelta

from pyspark.sql import functions as F

from loanstrata.operators.dedup import pack
from loanstrata.plans.quality import bronze_metrics
from loanstrata.sources.lake import Lake, _tally

A, B = date(2023, 1, 1), date(2023, 2, 1)


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_hold_no_groups_of_a_scan(spark):
    """Rows of a key meet before they are grouped: below the exchange there is no aggregate."""
    schema = "`Customer ID` string, `Snapshot-Date` string"
    a, b = "2023-01-01", "2023-02-01"
    raw = {
        "lms": spark.createDataFrame([(" X", a), ("x ", a), ("y", a), (None, a), (None, a), ("x", b), ("x", "?")], schema),
        "attributes": spark.createDataFrame([("x", a), ("z", None), ("z", "")], schema),
    }
    metrics = bronze_metrics(raw, [A])
    by_key = text(metrics).split("Exchange hashpartitioning(customer_id")
    assert len(by_key) == 2 and "Aggregate" not in by_key[1]
    found = {(r.source, r.snapshot_date, r.metric): r.value for r in metrics.collect()}
    names = ("rows_loaded", "rows_kept", "duplicates_removed", "rows_off_calendar")
    expected = {
        ("lms", A): (5, 3, 2, 0),
        ("lms", B): (1, 1, 0, 1),
        ("lms", None): (1, 1, 0, 0),
        ("attributes", A): (1, 1, 0, 0),
        ("attributes", None): (2, 1, 1, 0),
    }
    assert found == {(*k, m): n for k, values in expected.items() for m, n in zip(names, values)}
    assert {r.metric for r in bronze_metrics(raw).collect()} == set(names[:3])


def test_few_buckets_are_the_work_of_many_tasks(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("c"), F.col("id") % 500).alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.lit(A).alias("snapshot_date"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    lake = Lake(spark, str(tmp_path))
    try:
        assert lake.write(rows, "silver", "t", [A, B], buckets=2) == {A: 40_000, B: 0}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "silver" / "t" / "snapshot_date=2023-01-01").glob("*.parquet"))) > 2
    with lake.by_customer("silver", "t") as df:
        counted = df.groupBy("customer_id").agg(F.count("*").alias("n"))
        assert "Exchange hashpartitioning" not in text(counted)
        assert Counter(r.n for r in counted.collect()) == {80: 500}
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, rows.collect()))


def test_one_count_for_all_snapshots(spark, tmp_path):
    """Hundreds of snapshots cost a row of a write one step; the counts are exact."""
    days = [date(1969, 6, 1) + timedelta(k) for k in range(400)]
    rows = spark.range(0, 30_000, 1, 16).select(
        "id", F.date_add(F.lit(days[0]), F.pmod(F.hash("id"), F.lit(390)).cast("int")).alias("snapshot_date")
    )
    expected = {r[0]: r[1] for r in rows.groupBy("snapshot_date").count().collect()}
    lake = Lake(spark, str(tmp_path))
    # without a shuffle, so that every task meets every snapshot
    assert lake.write(rows.coalesce(4), "bronze", "t", days, rebalance=False) == dict.fromkeys(days, 0) | expected
    assert lake.rows("bronze", "t") == expected
    assert len(_tally(days)) == 1


def test_only_one_cell_of_a_packed_row_is_below_the_lambda(spark):
    """What is below a lambda is interpreted, cell by cell, and not compiled."""
    df = spark.createDataFrame([("a", None, "", "x\0y", "\1")], "a string, b string, c string, d string, e string")
    packed = df.select(pack([F.col(c) for c in df.columns]).alias("p"))
    assert packed.first().p == "\0".join(["\2a", "\1", "\2", "\2x\1\1y", "\2\1\2"])
    below = packed._jdf.queryExecution().analyzed().toString().split("filter(")[1].split("lambdafunction")[0]
    assert below.count("coalesce") == 1
