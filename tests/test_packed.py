"""Rows packed for the deduplication: the same order, the same values, fewer bytes and one shuffle."""

from __future__ import annotations

import itertools
import random
import re

from pyspark.sql import functions as F

from catalogue import views
from loanstrata.operators.dedup import keep_one
from loanstrata.plans import gold
from loanstrata.plans.bronze import bronze_rows
from loanstrata.plans.silver import clean
from loanstrata.schemas import SOURCES
from loanstrata.sources.lake import Lake, export_csv
from loanstrata.sources.raw import read_raw

SF = "/root/testdata/sf0.001"
CELLS = [None, "", "\0", "\1", "\2", "\0\1", "\1\1", "\1\2", "\1\0", "a", "a\0", "a\1", "ab", "é", "\U0001f600"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def smallest(rows):
    found = {}
    for k, *rest in rows:
        # NULL first, then by bytes, column by column
        order = [(v is not None, v.encode() if isinstance(v, str) else v) for v in rest]
        if k not in found or order < found[k][0]:
            found[k] = (order, tuple(rest))
    return {k: rest for k, (_, rest) in found.items()}


def test_packed_rows_keep_their_order_and_their_values(spark):
    pairs = list(itertools.product(CELLS, repeat=2))
    chance = random.Random(7)
    rows = [(f"one {i}", *p) for i, p in enumerate(pairs)]
    rows += [(f"two {i}", *chance.choice(pairs)) for i in range(400) for _ in range(2)]
    df = spark.createDataFrame(rows, "k string, a string, `b.c` string").repartition(4)
    kept = keep_one(df, ["k"])
    assert kept.columns == ["k", "a", "b.c"] and kept.dtypes == df.dtypes
    assert {r[0]: (r[1], r[2]) for r in kept.collect()} == smallest(rows)


def test_columns_of_other_types_keep_their_place(spark):
    chance = random.Random(8)
    rows = [
        (chance.choice([None, *range(40)]), *[chance.choice(CELLS[:5]) for _ in range(2)],
         chance.choice([None, 1, 2]), *[chance.choice(CELLS[:5]) for _ in range(3)])
        for _ in range(600)
    ]
    df = spark.createDataFrame(rows, "k int, a string, b string, n int, c string, d string, e string")
    kept = keep_one(df.select("a", "b", "k", "n", "c", "d", "e"), ["k"])
    assert kept.columns == ["a", "b", "k", "n", "c", "d", "e"]
    assert {r.k: (r.a, r.b, r.n, r.c, r.d, r.e) for r in kept.collect()} == smallest(rows)


def test_the_sort_before_the_shuffle_has_packed_rows(spark):
    text = plan(keep_one(bronze_rows(views.raw_lms(spark, SF)).withColumnRenamed("Customer_ID", "customer_id"),
                         ["customer_id", "snapshot_date"]))
    # what is sorted and shuffled: the keys and one text
    partial = re.search(r"functions=\[partial_min\(([^)]*)\)", text).group(1)
    assert re.fullmatch(r"run_0#\d+", partial)


def test_the_store_reads_the_shuffles_of_its_medians_and_masks_again(spark):
    silver = {n: clean(n, bronze_rows(views.RAW[n](spark, SF))) for n in SOURCES}
    store = gold.feature_store(silver)
    store.collect()
    assert plan(store).split("Initial Plan")[0].count("ReusedExchange") >= 2


def test_rows_without_a_customer_are_in_no_store(spark):
    silver = {n: clean(n, bronze_rows(views.RAW[n](spark, SF))) for n in SOURCES}
    nobody = {n: df.withColumn("customer_id", F.lit(None).cast("string")) for n, df in silver.items()}
    assert gold.feature_store(nobody).isEmpty() and not gold.feature_store(silver).isEmpty()


def test_compressed_raw_files(spark, tmp_path):
    df = spark.createDataFrame([("a", "x, y"), ("b", None)], "Customer_ID string, `fe 1` string")
    export_csv(df, f"{tmp_path}/raw.csv", "gzip")
    assert list((tmp_path / "raw.csv").glob("*.csv.gz"))
    assert sorted(map(tuple, read_raw(spark, f"{tmp_path}/raw.csv").collect())) == [("a", "x, y"), ("b", None)]


def test_shuffles_of_a_write_are_let_go(spark, tmp_path):
    collected = []
    lake = Lake(spark, str(tmp_path))
    manager = spark._jvm.java.lang.management.ManagementFactory
    before = sum(b.getCollectionCount() for b in manager.getGarbageCollectorMXBeans())
    lake.write(spark.sql("SELECT 'a' AS v, DATE'2023-01-01' AS snapshot_date"), "silver", "t",
               [__import__("datetime").date(2023, 1, 1)])
    collected.append(sum(b.getCollectionCount() for b in manager.getGarbageCollectorMXBeans()))
    assert collected[0] > before
