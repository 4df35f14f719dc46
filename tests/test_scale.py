"""Plans and hot keys: what must hold for tables that do not fit one task."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from catalogue import views
from catalogue.queries import QUERIES
from loanstrata.operators.dedup import keep_one, latest
from loanstrata.functions.dates import month_starts
from loanstrata.operators.merge import inner_merge, join_audit
from loanstrata.plans import delinquency, gold
from loanstrata.plans.bronze import bronze_rows
from loanstrata.plans.silver import clean
from loanstrata.schemas import KEYS, SOURCES
from loanstrata.sources.lake import Lake

SF = "/root/testdata/sf0.001"
LAZY = [
    n for n in QUERIES if not n.startswith(("backfill", "csv_export")) and n not in ("widened_clickstream", "stored_run_metrics")
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_no_cross_joins_windows_or_python(spark):
    for name in LAZY:
        text = plan(QUERIES[name](spark, SF))
        for operator in ("CartesianProduct", "NestedLoop", "Window", "Python", "ArrowEval", "Pandas"):
            assert operator not in text, (name, operator)


def test_dedup_combines_before_the_shuffle(spark):
    """A key with a third of all rows leaves each map task as one row."""
    n = 90_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, n, 1, 6).select(
        hot.alias("customer_id"), F.lit("2023-01-01").cast("date").alias("snapshot_date"), "id"
    )
    for result in (keep_one(df, KEYS), latest(df.drop("snapshot_date"), ["customer_id"], "id")):
        text = plan(result)
        assert text.count("Exchange hashpartitioning") == 1
        assert re.search(r"partial_(min|max)", text.split("Exchange hashpartitioning")[1])
        assert result.count() == n // 3 * 2 + 1
    hot_row = keep_one(df, KEYS).where("customer_id = 'hot'").collect()
    assert [r.id for r in hot_row] == [0]


def test_feature_store_shuffles_the_sources_once(spark, tmp_path):
    silver = {n: _silver(spark, n) for n in SOURCES}
    lake = Lake(spark, str(tmp_path))
    months = month_starts("1997-01-01", "1997-02-01")
    for name, df in silver.items():
        lake.write(df, "silver", name, months)
    stored = {n: lake.read("silver", n, months[:1]) for n in SOURCES}
    text = plan(gold.feature_store(stored, on_missing="strict"))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert all("snapshot_date=1997-01-01" in f for df in stored.values() for f in df.inputFiles())
    assert "PushedFilters: [IsNotNull(mob), EqualTo(mob,6)" in text
    # the default mode adds the two presence reads: of a partition column, and of the months on book
    spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.enabled", "false")  # it repeats subplans in the text
    default = plan(gold.feature_store(stored))
    spark.conf.unset("spark.sql.optimizer.dynamicPartitionPruning.enabled")
    assert default.count("FileScan") == text.count("FileScan") + 2
    assert default.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in default
    assert default.count("ReadSchema: struct<mob:int>") == 1
    schema = re.search(r"silver/attributes.*?ReadSchema: struct<([^>]*)>", text, re.S)
    assert schema is None or "ssn" not in schema.group(1)


def _silver(spark, name):
    return clean(name, bronze_rows(views.RAW[name](spark, SF)))


def test_write_splits_a_hot_snapshot(spark, tmp_path):
    days = month_starts("2023-01-01", "2023-12-01")
    month = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 12)
    df = spark.range(0, 600_000, 1, 8).select(
        F.add_months(F.lit(days[0]), month.cast("int")).alias("snapshot_date"),
        F.sha1(F.col("id").cast("string")).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        lake = Lake(spark, str(tmp_path))
        lake.write(df, "gold", "t", days)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "gold" / "t").glob("snap*")}
    assert files["snapshot_date=2023-01-01"] >= 3
    assert sum(files.values()) < 8 * 12  # fewer than one per map task and snapshot
    assert lake.read("gold", "t").count() == 600_000


def test_audit_of_a_hot_customer_does_not_overflow(spark):
    n = 100_000
    hot = spark.range(n).select(
        F.lit("hot").alias("customer_id"), F.lit("2023-01-01").cast("date").alias("snapshot_date")
    )
    audit = join_audit({"clickstream": hot, "attributes": hot, "financials": hot, "lms": hot})
    got = {r.step: (r.rows_after, r.customers_after) for r in audit.collect()}
    assert got == {1: (n**2, 1), 2: (n**3, 1), 3: (None, 1)}


def test_age_median_reuses_the_deduplicated_shuffle(spark):
    assert "ReusedExchange" in final_plan(_silver(spark, "attributes"))


def test_histogram_reads_its_input_once(spark):
    obs = delinquency.observations(spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_linenumber").alias("dpd"),
        F.lit("2000-01-01").cast("date").alias("loan_start_date"),
        F.lit(0).alias("installments_missed"),
    ))
    text = final_plan(delinquency.dpd_histogram(obs))
    assert "ReusedExchange" in text


def test_merge_joins_do_not_reshuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [
            gold.features(n, spark.createDataFrame([], _silver(spark, n).schema)) for n in SOURCES
        ]
        text = plan(inner_merge(frames))
        assert text.count("Exchange hashpartitioning") <= len(SOURCES)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
