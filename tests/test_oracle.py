"""Every query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES
from oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert differences(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["loan_id", "customer_id", "label", "label_def", "snapshot_date"]
    assert df.count() > 0
