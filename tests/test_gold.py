"""Label store and feature store."""

from __future__ import annotations

from datetime import date

import pytest

from pyspark.sql import functions as F

from loanstrata.operators.merge import inner_merge, join_audit
from loanstrata.plans import gold
from loanstrata.schemas import FEATURE_STORE, LABEL_STORE, SOURCES

S1, S2 = date(2023, 1, 1), date(2023, 2, 1)


@pytest.fixture()
def silver(spark):
    """Two snapshots; in the second no loan is at six months on book."""
    keys = "customer_id string, snapshot_date date"
    clickstream = [("a", S1, 1.0, 3.0), ("b", S1, 1.0, None), (None, S1, 1.0, 1.0), ("a", S2, 2.0, 2.0)]
    attributes = [("a", S1, 30.0, "x"), ("b", S1, 24.5, "y"), (None, S1, 1.0, "z"), ("a", S2, 50.0, "x"), ("q", S2, 50.0, "x")]
    financials = [
        ("a", S1, 100.0, 10.0, 5.0, 1.0, "2.5", 1.5),
        ("b", S1, 0.0, 10.0, 0.0, 1.0, "junk", 0.0),
        ("a", S2, 100.0, 0.0, 5.0, 1.0, "2.5", 1.5),
    ]
    loans = [
        ("a", S1, "l1", date(2022, 7, 1), 6, 6, 200.0, 100.0, 59, 2),
        ("b", S1, "l2", date(2022, 7, 1), 6, 6, 5.0, 0.0, None, 0),
        ("a", S2, "l1", date(2022, 7, 1), 7, 7, 0.0, 100.0, 0, 0),
    ]
    return {
        "clickstream": spark.createDataFrame(clickstream, f"{keys}, fe_1 double, fe_2 double"),
        "attributes": spark.createDataFrame(attributes, f"{keys}, age double, occupation string"),
        "financials": spark.createDataFrame(
            financials,
            f"{keys}, annual_income double, outstanding_debt double, monthly_inhand_salary double,"
            " total_emi_per_month double, monthly_balance string, credit_history_age double",
        ),
        "lms": spark.createDataFrame(
            loans,
            f"{keys}, loan_id string, loan_start_date date, installment_num int, mob int,"
            " overdue_amt double, due_amt double, dpd int, installments_missed long",
        ),
    }


def by_key(df):
    return {(r.customer_id, r.snapshot_date): r for r in df.collect()}


def test_label_store(silver):
    df = gold.label_store(silver["lms"], dpd=30, mob=6)
    assert dict(df.dtypes) == LABEL_STORE
    assert sorted(map(tuple, df.collect())) == [
        ("l1", "a", 1, "30dpd_6mob", S1),
        ("l2", "b", 0, "30dpd_6mob", S1),
    ]


def test_feature_store_skips_sources_missing_from_a_snapshot(silver):
    df = gold.feature_store(silver)
    assert dict(df.dtypes) == FEATURE_STORE
    got = by_key(df)
    assert set(got) == {("a", S1), ("b", S1), ("a", S2)}
    a = got["a", S1]
    assert (a.clickstream_total_mean, a.age_group, a.occupation) == (2.0, "25-34", "x")
    assert (a.debt_to_income, a.emi_to_salary, a.balance_to_debt) == (0.1, 0.2, 0.25)
    assert (a.mob, a.installments_missed, a.first_missed_date) == (6.0, 2.0, date(2022, 12, 28))
    assert a.dpd == 4.0
    b = got["b", S1]
    assert (b.clickstream_total_mean, b.age_group) == (None, "other")
    assert (b.debt_to_income, b.emi_to_salary, b.balance_to_debt) == (None, None, None)
    assert (b.installments_missed, b.first_missed_date, b.dpd) == (0.0, None, 0.0)
    second = got["a", S2]
    assert (second.mob, second.dpd, second.first_missed_date) == (None, None, None)
    assert second.balance_to_debt is None and second.age_group == "45-56"


@pytest.mark.parametrize(
    ("empty", "kept"),
    [("clickstream", {"a", "b"}), ("attributes", set()), ("financials", set()), ("lms", {"a", "b"})],
)
def test_empty_month_of_a_source(silver, empty, kept):
    """Clickstream and loans may have no row in a snapshot; attributes and financials may not."""
    silver[empty] = silver[empty].where(f"snapshot_date <> '{S1}'")
    store = gold.feature_store(silver)
    assert {c for c, s in by_key(store) if s == S1} == kept
    audit = join_audit(gold.rows_by_source(silver)).where(f"snapshot_date = '{S1}'").orderBy("step").collect()
    assert audit[-1].rows_after == len(kept)
    left_out = {"clickstream": {"attributes"}, "lms": {"lms"}}.get(empty, set())
    assert [r.joined_source for r in audit] == [n for n in ("attributes", "financials", "lms") if n not in left_out]


def test_clickstream_without_features_is_skipped(silver):
    silver["clickstream"] = silver["clickstream"].drop("fe_1", "fe_2")
    assert set(by_key(gold.feature_store(silver))) == {("a", S1), ("b", S1), ("a", S2)}
    assert gold.feature_store(silver, on_missing="strict").count() == 0


def test_columns_that_a_month_never_had(silver):
    """A row's mean counts the columns of its own raw file; a blank cell in one of them is NULL."""
    listed = F.when(F.col("snapshot_date") == S2, "fe_1").when(F.col("customer_id") == "b", "").otherwise("fe_1,fe_2")
    silver["clickstream"] = silver["clickstream"].withColumn("source_columns", listed)
    got = {k: r.clickstream_total_mean for k, r in by_key(gold.features("clickstream", silver["clickstream"])).items()}
    assert got == {("a", S1): 2.0, (None, S1): 1.0, ("a", S2): 2.0}


def test_feature_store_strict_equals_the_joins(silver):
    strict = gold.feature_store(silver, on_missing="strict")
    joined = inner_merge([gold.features(n, silver[n]) for n in SOURCES])
    assert set(by_key(strict)) == {("a", S1), ("b", S1)}
    assert by_key(strict) == by_key(joined.select(strict.columns))


def test_absent_source(silver):
    without = {**silver, "financials": None}
    got = by_key(gold.feature_store(without))
    assert set(got) == {("a", S1), ("b", S1), ("a", S2)}
    assert got["a", S1].debt_to_income is None and got["a", S1].age_group == "25-34"
    assert gold.feature_store(without, on_missing="strict").count() == 0
    del without["clickstream"]
    store = gold.feature_store(without)
    assert dict(store.dtypes) == FEATURE_STORE
    assert set(by_key(store)) == {("a", S1), ("b", S1), ("a", S2), ("q", S2)}


def test_feature_store_has_one_row_per_customer(silver):
    silver["attributes"] = silver["attributes"].unionAll(silver["attributes"])
    df = gold.feature_store(silver)
    assert df.count() == df.select("customer_id", "snapshot_date").distinct().count() == 3


def test_bad_arguments(silver):
    with pytest.raises(ValueError, match="on_missing"):
        gold.feature_store(silver, on_missing="maybe")
    with pytest.raises(ValueError, match="no source"):
        gold.feature_store({})
    with pytest.raises(ValueError, match="fe_"):
        gold.features("clickstream", silver["clickstream"].drop("fe_1", "fe_2"))


def test_latest_records(silver):
    latest = {r.customer_id: r for r in gold.latest_records(silver["attributes"]).collect()}
    assert latest["a"].snapshot_date == S2 and latest["b"].snapshot_date == S1
    earlier = {r.customer_id: r for r in gold.latest_records(silver["attributes"], "2023-01-31").collect()}
    assert earlier["a"].snapshot_date == S1 and "q" not in earlier
