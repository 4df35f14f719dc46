"""What lies on the executors' disks at a time: joins made once, rows cut to what is needed, jobs of bounded size."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from catalogue import queries, views
from loanstrata.functions.dates import month_starts
from loanstrata.plans import backfill, silver
from loanstrata.plans.bronze import bronze_rows
from loanstrata.schemas import FEATURE_INPUTS, LABEL_INPUTS, SNAPSHOT
from loanstrata.sources.lake import Lake, _rebalanced

SF = "/root/testdata/sf0.001"
A, B, C = date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Orders without a customer, lines without a part, and both twice; keys that are NULL."""
    folder = str(tmp_path_factory.mktemp("odd"))
    for name, key in (("customer", "c_custkey"), ("part", "p_partkey")):
        rows = views.table(spark, SF, name)
        twice = rows.where(F.col(key) % 5 == 1)
        lost = rows.limit(1).withColumn(key, F.lit(None).cast("bigint"))
        rows.where(F.col(key) % 7 != 0).unionAll(twice).unionAll(lost).write.parquet(f"{folder}/{name}.parquet")
    for name, key in (("orders", "o_custkey"), ("lineitem", "l_partkey")):
        rows = views.table(spark, SF, name)
        blank = F.when(F.col(key) % 11 != 0, F.col(key))
        rows.withColumn(key, blank).limit(1500).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_views_of_stored_lines_have_the_same_rows(spark, odd, tmp_path):
    stored = views.raw_sources(spark, odd, views.stored_lines(spark, odd, str(tmp_path / "lines")))
    plain = views.raw_sources(spark, odd)
    for name, df in plain.items():
        rows = found(df)
        assert rows and found(stored[name]) == rows, name
    # of parts and accounts the financials of the features need these
    scanned = text(silver.clean("financials", bronze_rows(stored["financials"]), FEATURE_INPUTS["financials"]))
    assert "Join" not in scanned and "p_retailprice" in scanned


def test_customers_meet_the_orders_before_the_lines_do(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = text(views.raw_financials(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plain_joins(plan) if "o_custkey" in line]
    assert len(wide) == 1 and plan.count("Exchange hashpartitioning(l_") == 2


def plain_joins(plan):
    return [line for line in plan.splitlines() if "SortMergeJoin" in line]


def test_the_stores_join_lines_once_and_carry_no_loan_list(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("feature_store", "feature_store_strict", "feature_store_mob8"):
            plan = text(queries.QUERIES[name](spark, SF))
            # the one of orders and customers, for the attributes
            joins = plain_joins(plan)
            assert joins and all("o_custkey" in line for line in joins), name
            assert "High_spent" not in plan and "__10000__" in plan, name
        assert "High_spent" not in text(queries.merged_features(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_leading_columns_of_the_kept_row(spark):
    chance = random.Random(3)
    cells = [None, "", "1", "2", "10"]
    names = ["Customer ID", "b", "Snapshot-Date", "c", "d", "e"]
    rows = [(chance.choice("xyz"), chance.choice(cells), "2023-01-01", *[chance.choice(cells) for _ in range(3)]) for _ in range(90)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    assert silver.leading(df, ["b", "c"]).columns == silver.leading(df, ["snapshot_date", "b"]).columns == names[:4]
    assert silver.leading(df, ["d"]).columns == names[:5]
    assert silver.leading(df.select("b", "c", "d", "Customer ID"), ["c"]).columns == ["b", "c", "Customer ID"]
    assert silver.leading(df, ["e"]).columns == silver.leading(df, ["other"]).columns == names
    whole = silver.normalize(df)
    for last in "bcde":
        part = silver.normalize(silver.leading(df, [last]))
        assert found(part) == found(whole.select(part.columns)) and len(found(part)) == 3
    lms = bronze_rows(views.raw_lms(spark, SF))
    part = silver.clean("lms", lms, LABEL_INPUTS)
    assert "balance" not in part.columns and found(part) == found(silver.clean("lms", lms).select(part.columns))


def test_groups_of_months():
    rows = {A: 5, B: 6, C: 20}
    assert backfill.job_groups([A, B, C], rows) == [[A, B, C]]
    assert backfill.job_groups([A, B, C], rows, 11) == [[A, B], [C]]
    assert backfill.job_groups([A, B, C], rows, 10) == [[A], [B], [C]]
    assert backfill.job_groups([A, C, B], {C: 1}, 1) == [[A, C, B]]
    assert backfill.job_groups([], rows) == [[]]


def test_jobs_of_bounded_size_write_the_same(spark, tmp_path, monkeypatch):
    start, end = "1997-01-01", "1997-04-01"
    raw = views.raw_sources(spark, SF)
    lakes = {}
    for most in (backfill.ROWS_PER_JOB, 150):
        monkeypatch.setattr(backfill, "ROWS_PER_JOB", most)
        lakes[most] = Lake(spark, str(tmp_path / str(most)))
        backfill.backfill(lakes[most], raw, start, end, audit=True)
    whole, parts = lakes.values()
    tables = [("silver", n) for n in raw] + [("gold", "label_store"), ("gold", "feature_store"), ("quality", "join_audit")]
    for table in tables:
        assert found(whole.read(*table)) == found(parts.read(*table)), table
    assert len(set(whole.runs("silver", "lms").values())) == 1 < len(set(parts.runs("silver", "lms").values()))
    assert len(set(parts.runs("gold", "customer_rows").values())) > 1


def test_silver_from_the_views_in_groups(spark, monkeypatch):
    months = month_starts("1997-01-01", "1997-06-01")
    whole = queries._silver_lake(spark, SF, months)
    monkeypatch.setattr(backfill, "ROWS_PER_JOB", 150)
    parts = queries._silver_lake(spark, SF, months, buckets=3)
    for name in FEATURE_INPUTS:
        a, b = whole.read("silver", name), parts.read("silver", name)
        assert found(a) == found(b.select(a.columns)) and whole.rows("silver", name) == parts.rows("silver", name)
    assert len(set(parts.runs("silver", "lms").values())) > 1


def test_text_rows_travel_packed(spark, tmp_path):
    names = [f"c {i}" for i in range(7)] + ["x.y", "source_columns"]
    cells = [None, "", "a", "\0", "\1", "\1\2", "b\0\1", "é", " z "]
    chance = random.Random(5)
    rows = [(i, *[chance.choice(cells) for _ in names], chance.choice([A, B])) for i in range(300)]
    df = spark.createDataFrame(rows, f"n int, {', '.join(f'`{n}` string' for n in names)}, {SNAPSHOT} date")
    dealt = _rebalanced(df)
    assert dealt.columns == df.columns and dealt.dtypes == df.dtypes and found(dealt) == found(df)
    assert "__cells" in text(dealt).split("Exchange")[1]
    assert "__cells" not in text(_rebalanced(df.drop("c 1", "c 2")))
    lake = Lake(spark, str(tmp_path))
    lake.write(df, "bronze", "t", [A, B])
    assert found(lake.read("bronze", "t")) == found(df)


def test_exports_are_compressed(spark):
    rows = queries.QUERIES["csv_export_financials"](spark, SF)
    assert all(f.endswith(".csv.gz") for f in rows.inputFiles())
    assert found(rows) == found(queries.QUERIES["silver_financials"](spark, SF))
