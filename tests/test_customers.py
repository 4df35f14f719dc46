"""Distinct customers from bitmaps: any set of snapshots, new and rewritten ones, hot and missing customers."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from loanstrata.functions.dates import month_starts
from loanstrata.plans import customers
from loanstrata.plans.backfill import load_customers
from loanstrata.plans.quality import store_summary
from loanstrata.schemas import LABEL_STORE, ddl
from loanstrata.sources.lake import Lake

DAYS = month_starts("2023-01-01", "2023-06-01")
A, B, C = DAYS[:3]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def store(spark, *rows):
    """Label-store rows of (customer, snapshot)."""
    return spark.createDataFrame([("l", c, 0, "x", day) for c, day in rows], ddl(LABEL_STORE))


def check(lake, snapshots=None):
    """The bitmaps count what `store_summary` counts on the rows."""
    stores = {n: lake.read("gold", n, snapshots) for n in customers.STORES}
    expected = store_summary({n: df for n, df in stores.items() if df is not None})
    found = customers.counted_summary(lake, snapshots)
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    return {r.store: r.n_customers for r in found.collect()}


def numbers(lake):
    ids = {r.customer_id: r.id for r in lake.read("analysis", "customer_ids").collect()}
    assert len(set(ids.values())) == len(ids) and min(ids.values()) > 0
    return ids


@pytest.mark.parametrize("buckets", [0, 3])
def test_any_set_of_snapshots(spark, lake, buckets):
    n = 90_000  # more than two blocks
    day = F.array(*[F.lit(d) for d in DAYS])[(F.col("id") % 6).cast("int")]
    # a third of the rows belongs to one customer, a sixth to none
    who = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None).otherwise(
        F.concat(F.lit("c"), (F.col("id") % 40_000).cast("string"))
    )
    rows = spark.range(0, n, 1, 8).select(
        F.lit("l").alias("loan_id"), who.alias("customer_id"), F.lit(0).alias("label"),
        F.lit("x").alias("label_def"), day.alias("snapshot_date"),
    )
    lake.write(rows, "gold", "label_store", DAYS)
    load_customers(lake, buckets)
    for asked in (None, DAYS[:1], DAYS[1:4], [DAYS[0], DAYS[5]]):
        check(lake, asked)
    ids = numbers(lake)
    assert set(ids) == {r[0] for r in rows.select("customer_id").distinct().collect()} - {None}
    blocks = lake.read("analysis", "label_store_customers")
    # numbers are dense: a block holds up to 32768 of the customers that came in its snapshot
    assert blocks.select("block").distinct().count() <= len(DAYS) + len(ids) // 32768 + 1
    # a customer's number is in the block of the first snapshot
    first = {r[0]: r[1] for r in rows.groupBy("customer_id").agg(F.min("snapshot_date")).collect()}
    assert {(i >> 32) - customers._FIRST_DAY for c, i in ids.items() if first[c] == A} == {(A - date(1970, 1, 1)).days}


def test_new_and_rewritten_snapshots(spark, lake):
    lake.write(store(spark, ("a", A), ("b", A), (None, A), ("a", B)), "gold", "label_store", [A, B])
    load_customers(lake)
    assert check(lake) == {"label_store": 3} and check(lake, [B]) == {"label_store": 1}
    before = numbers(lake)
    # a month more, and a store more that shares customers
    lake.write(store(spark, ("c", C), ("b", C)), "gold", "label_store", [C])
    with pytest.raises(ValueError, match="out of date"):
        customers.counted_summary(lake)
    assert customers.refresh_customers(lake, "label_store") == [C]
    assert customers.refresh_customers(lake, "label_store") == []
    assert check(lake) == {"label_store": 4}
    # a month written again: other customers, one of them new, one gone
    lake.write(store(spark, ("d", A), ("b", A), ("e", A)), "gold", "label_store", [A])
    load_customers(lake)
    assert check(lake) == {"label_store": 5} and check(lake, [A]) == {"label_store": 3}
    after = numbers(lake)
    assert before.items() <= after.items() and set(after) == set("abcde")
    # a month that lost its rows, then all of them
    lake.write(store(spark).limit(0), "gold", "label_store", [C])
    load_customers(lake)
    assert check(lake) == {"label_store": 4} and check(lake, [C]) == {}
    lake.write(store(spark).limit(0), "gold", "label_store", [A, B, C])
    load_customers(lake)
    assert check(lake) == {}
    assert numbers(lake) == after


def test_two_at_the_same_time(spark, lake):
    """The call that ends later has numbered a customer that now has a number: it must not commit."""
    rows = store(spark, ("a", A))
    lake.write(rows, "gold", "label_store", [A])
    versions = lake.versions("analysis", "customer_ids")

    class Slow(Lake):
        def write(self, *args, **kwargs):
            if not versions.numbers():
                customers.number_customers(lake, rows, [A])
            return super().write(*args, **kwargs)

    with pytest.raises(RuntimeError, match="changed: version 1, not 0"):
        customers.number_customers(Slow(spark, lake.root), store(spark, ("a", B)), [B])
    assert versions.numbers() == [1] and list(numbers(lake)) == ["a"]


def test_plan(spark, lake):
    lake.write(store(spark, ("a", A)), "gold", "label_store", [A])
    load_customers(lake, 2)
    blocks = lake.read("analysis", "label_store_customers")
    text = customers.distinct_customers(blocks)._jdf.queryExecution().executedPlan().toString()
    # blocks are merged before the shuffle
    assert text.count("bitmap_or_agg") >= 2 and "CartesianProduct" not in text and "NestedLoop" not in text
    with lake.by_customer("analysis", "customer_ids") as ids:
        rows = lake.read("gold", "label_store")
        text = customers.bitmaps(rows, ids)._jdf.queryExecution().executedPlan().toString()
        assert text.count("Scan parquet") == 2
