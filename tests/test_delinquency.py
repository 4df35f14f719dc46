"""Delinquency tables against brute force."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from loanstrata.plans import delinquency as d
from loanstrata.plans import quality

ROWS = [
    # loan, customer, start, installment, mob, dpd, snapshot
    ("l1", "a", date(2023, 1, 1), 1, 1, 0, date(2023, 1, 1)),
    ("l1", "a", date(2023, 1, 1), 10, 10, 45, date(2023, 10, 1)),
    ("l2", "b", date(2023, 6, 1), 6, 6, 31, date(2023, 6, 1)),
    ("l2", "b", date(2023, 6, 1), 7, 7, 0, date(2023, 7, 1)),
    ("l3", "c", date(2023, 6, 1), 6, 6, None, date(2023, 6, 1)),
    ("l4", "d", date(2024, 1, 1), 6, 6, 90, date(2023, 6, 1)),
]


@pytest.fixture()
def obs(spark):
    columns = "loan_id string, customer_id string, loan_start_date date, installment_num int, mob int, dpd int, snapshot_date date"
    rows = spark.createDataFrame(ROWS, columns).withColumn("installments_missed", F.lit(0))
    return d.observations(rows, dpd=30)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_only_loans_started_before_the_cut_off(obs):
    assert obs.count() == 5
    assert {r.dpd_flag for r in obs.where("dpd is null").collect()} == {0}


def test_by_mob(obs):
    assert rows(d.bad_rate_by_mob(obs)) == [(1, 0.0), (6, 0.5), (7, 0.0), (10, 1.0)]
    assert rows(d.mob_counts(obs)) == [(1, 1), (6, 2), (7, 1), (10, 1)]
    assert rows(d.dpd_by_mob(obs)) == [(1, 0.0), (6, 31.0), (7, 0.0), (10, 45.0)]


def test_last_observations(obs):
    assert [r.loan_id for r in d.actual_bads(obs).collect()] == ["l1"]
    assert rows(d.actual_bads_summary(obs)) == [(3, 1)]
    assert [r.loan_id for r in d.at_installment(obs).collect()] == ["l1"]


def test_ties_of_the_last_observation(spark, obs):
    row = obs.where("loan_id = 'l1' and mob = 10").collect()[0]
    later = {**row.asDict(), "snapshot_date": date(2023, 12, 1), "dpd": 0, "dpd_flag": 0}
    tied = obs.unionByName(spark.createDataFrame([later], obs.schema))
    assert rows(d.actual_bads_summary(tied)) == [(3, 0)]
    assert d.actual_bads(tied).isEmpty()
    same_day = {**later, "dpd": 31, "dpd_flag": 1}
    tied = tied.unionByName(spark.createDataFrame([same_day], obs.schema))
    assert rows(d.actual_bads_summary(tied)) == [(3, 1)]
    assert d.actual_bads(tied).count() == 1


def test_thresholds(obs):
    got = {r.threshold: (r.n_at_or_above, r.pct_at_or_above) for r in d.dpd_thresholds(obs).collect()}
    assert got[1] == got[30] == (2, 40.0) and got[60] == (0, 0.0)
    assert sorted(got) == d.DPD_THRESHOLDS


def test_default_split(obs):
    got = {r.threshold: tuple(r)[1:] for r in d.default_split(obs, mob=6).collect()}
    assert got == {20: (1, 1, 50.0), 30: (1, 1, 50.0), 60: (2, 0, 0.0), 90: (2, 0, 0.0)}


def test_histogram_up_to_a_value(obs):
    got = d.dpd_histogram(obs, bins=3, at_most=40).orderBy("bin").collect()
    assert [r.n_obs for r in got] == [2, 0, 1]


def test_summary(obs):
    assert rows(d.summary(obs)) == [(5, 3, 1, 10, 0, 45, 0.4)]


def test_preview(obs):
    assert [r.loan_id for r in quality.preview(obs, ["loan_id", "mob"], 2).collect()] == ["l1", "l1"]
