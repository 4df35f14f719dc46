"""Silver dealt by customer: the same rows, and gold without an exchange by customer."""

from __future__ import annotations

from contextlib import ExitStack
from datetime import date

import pytest

from catalogue import views
from loanstrata.functions.dates import month_starts
from loanstrata.operators.merge import inner_merge, join_audit
from loanstrata.plans import gold
from loanstrata.plans.backfill import backfill
from loanstrata.schemas import SOURCES
from loanstrata.sources.lake import Lake

SF = "/root/testdata/sf0.001"
START, END = "1997-01-01", "1997-04-01"
MONTHS = month_starts(START, END)
A, B = date(2023, 1, 1), date(2023, 2, 1)


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def rows(spark, day, *values, columns="customer_id string, v int"):
    return spark.createDataFrame([(*v, day) for v in values], f"{columns}, snapshot_date date")


@pytest.fixture(scope="module")
def raw(spark):
    return {name: views.RAW[name](spark, SF) for name in SOURCES}


@pytest.fixture(scope="module")
def plain(spark, raw, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("plain")))
    backfill(lake, raw, START, END, audit=True)
    return lake


@pytest.fixture(scope="module")
def dealt(spark, raw, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("dealt")))
    backfill(lake, raw, START, END, audit=True, buckets=4)
    return lake


def test_the_same_tables(spark, plain, dealt):
    tables = [("silver", n) for n in SOURCES]
    tables += [("gold", "label_store"), ("gold", "feature_store"), ("gold", "customer_rows"), ("quality", "join_audit")]
    for layer, table in tables:
        a, b = plain.read(layer, table), dealt.read(layer, table)
        assert found(a.select(sorted(a.columns))) == found(b.select(sorted(a.columns))), table
        assert plain.rows(layer, table) == dealt.rows(layer, table)
    assert dealt.read("gold", "feature_store").count() > 0


def test_no_exchange_by_customer(spark, plain, dealt):
    def shuffled(df):
        return "Exchange hashpartitioning(customer_id" in text(df)

    for lake, n in ((plain, True), (dealt, False)):
        with ExitStack() as opened:
            silver = {s: opened.enter_context(lake.by_customer("silver", s, MONTHS)) for s in SOURCES}
            store = gold.feature_store(silver)
            assert shuffled(store) == n
            features = gold.rows_by_source(silver)
            assert shuffled(gold.customer_rows(features)) == n
            assert shuffled(join_audit(features, "strict")) == n
            latest = gold.latest_records(silver["attributes"])
            assert shuffled(latest) == n
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
            merged = inner_merge([silver["attributes"].drop("snapshot_date"), silver["financials"]], ["customer_id"])
            assert shuffled(merged) == n
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            # the columns read are those that are needed
            assert "ssn" not in text(store).split("ReadSchema")[-1]
            expected = found(store)
        assert found(gold.feature_store({s: lake.read("silver", s, MONTHS) for s in SOURCES})) == expected


def test_only_files_that_count(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for day, values in ((A, [("a", 1), ("b", 2)]), (B, [("a", 3), ("c", 4)]), (A, [("b", 5), (None, 6)])):
        lake.write(rows(spark, day, *values), "silver", "t", [day], buckets=3)
    expected = [("a", 3, B), ("b", 5, A), ("c", 4, B), (None, 6, A)]
    assert found(lake.read("silver", "t")) == sorted(expected, key=str)
    with lake.by_customer("silver", "t") as df:
        assert found(df) == sorted(expected, key=str) and df.columns == ["customer_id", "v", "snapshot_date"]
    with lake.by_customer("silver", "t", [B]) as df:
        assert found(df) == [("a", 3, B), ("c", 4, B)]
        assert all("snapshot_date=2023-02-01" in f for f in df.inputFiles())
    with lake.by_customer("silver", "t", [date(2023, 5, 1)]) as df:
        assert df.isEmpty()
    with lake.by_customer("silver", "never") as df:
        assert df is None


def test_other_numbers_of_buckets_are_read_plainly(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(rows(spark, A, ("a", 1), ("b", 2)), "silver", "t", [A], buckets=3)
    lake.write(rows(spark, B, ("a", 3)), "silver", "t", [B])
    with lake.by_customer("silver", "t") as df:
        assert "Bucketed: true" not in text(df.groupBy("customer_id").count())
        assert found(df.groupBy("customer_id").count()) == [("a", 2), ("b", 1)]
    with lake.by_customer("silver", "t", [A]) as df:
        counted = df.groupBy("customer_id").count()
        assert "Exchange" not in text(counted) and found(counted) == [("a", 1), ("b", 1)]


def test_columns_and_names(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "it's a lake"))
    df = rows(spark, A, ("a", 1, 2.5), columns="customer_id string, `fe 1.x` int, `date` double")
    lake.write(df, "silver", "t", [A], buckets=2)
    lake.write(rows(spark, B, ("b", 7)), "silver", "t", [B], buckets=2)
    with lake.by_customer("silver", "t") as df:
        assert found(df) == [("a", 1, 2.5, None, A), ("b", None, None, 7, B)]
    # nothing to deal by
    lake.write(df.drop("customer_id"), "silver", "u", [], buckets=2)
    other = spark.createDataFrame([(1, A)], "v int, snapshot_date date")
    lake.write(other, "silver", "u", [A], buckets=2)
    with lake.by_customer("silver", "u") as df:
        assert found(df) == [(1, A)]


def test_nothing_is_left_in_the_catalog(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    before = {t.name for t in spark.catalog.listTables()}
    lake.write(rows(spark, A, ("a", 1)), "silver", "t", [A], buckets=2)
    with pytest.raises(Exception, match="bad row"):
        broken = rows(spark, A, ("b", 2)).selectExpr("customer_id", "raise_error('bad row') AS v", "snapshot_date")
        lake.write(broken.selectExpr("customer_id", "CAST(v AS int) AS v", "snapshot_date"), "silver", "t", [A], buckets=2)
    with pytest.raises(KeyError), lake.by_customer("silver", "t") as df:
        assert found(df) == [("a", 1, A)]
        raise KeyError
    assert {t.name for t in spark.catalog.listTables()} == before
    # files of one snapshot: one for each bucket that has rows, and none of the failed write counts
    assert lake.rows("silver", "t") == {A: 1} and found(lake.read("silver", "t")) == [("a", 1, A)]
