"""Shared operators: normalisation, one row per key, merging, audit, distributions."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest

from loanstrata.operators.dedup import keep_one, latest
from loanstrata.operators.distribution import equal_width_histogram, exceedance
from loanstrata.operators.merge import inner_merge, join_audit, source_coverage, sources_present
from loanstrata.operators.normalize import normalize_names, normalize_strings

S1, S2 = date(2023, 1, 1), date(2023, 2, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def keyed(spark, pairs):
    return spark.createDataFrame(pairs, "snapshot_date date, customer_id string")


def test_names_and_strings(spark):
    df = spark.createDataFrame([("  A ", 1)], " `Customer ID ` string, `Num-X` int")
    got = normalize_strings(normalize_names(df))
    assert got.columns == ["customer_id", "num_x"]
    assert rows(got) == [("a", 1)]


def test_colliding_names_are_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        normalize_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_keep_one_takes_the_smallest_row_with_null_first(spark):
    df = spark.createDataFrame(
        [("k", "b", 1), ("k", "a", 9), ("k", "a", 2), ("n", None, 7), ("n", "a", 1), (None, "x", 1), (None, "x", 0)],
        "k string, a string, b int",
    )
    got = {r.k: (r.a, r.b) for r in keep_one(df.repartition(4), ["k"]).collect()}
    assert got == {"k": ("a", 2), "n": (None, 7), None: ("x", 0)}


def test_keep_one_without_other_columns(spark):
    assert rows(keep_one(spark.createDataFrame([("a",), ("a",)], "k string"), ["k"])) == [("a",)]


def test_latest(spark):
    df = spark.createDataFrame(
        [("c", S1, 5), ("c", S2, 1), ("c", S2, 3), ("d", None, 1), ("d", S1, 0)],
        "customer_id string, snapshot_date date, v int",
    )
    assert rows(latest(df, ["customer_id"], "snapshot_date")) == [("c", S2, 3), ("d", S1, 0)]


def test_inner_merge_keeps_left_columns(spark):
    a = spark.createDataFrame([(S1, "c", 1)], "snapshot_date date, customer_id string, x int")
    b = spark.createDataFrame([(S1, "c", 2, 3), (S1, "d", 2, 3)], "snapshot_date date, customer_id string, x int, y int")
    assert rows(inner_merge([a, b])) == [("c", S1, 1, 3)]
    with pytest.raises(ValueError, match="key"):
        inner_merge([a, b.drop("customer_id")])


def test_join_audit_matches_real_joins(spark):
    left = keyed(spark, [(S1, "a"), (S1, "a"), (S1, "b"), (S2, "c"), (S1, None)])
    right = keyed(spark, [(S1, "a"), (S1, "a"), (S1, "z"), (S1, None)])
    frames = {"clickstream": left, "lms": right}
    # a snapshot without loans has no step, unless every source takes part
    assert [r.snapshot_date for r in join_audit(frames).collect()] == [S1]
    audit = {r.snapshot_date: r for r in join_audit(frames, "strict").collect()}
    first, second = audit[S1], audit[S2]
    joined = left.join(right, ["snapshot_date", "customer_id"]).where("snapshot_date = '2023-01-01'")
    assert (first.rows_before, first.customers_before) == (4, 3)
    assert (first.right_rows, first.right_customers) == (4, 3)
    assert first.rows_after == joined.count() == 4
    assert first.customers_after == 1
    assert first.has_duplicates and first.rows_lost == 0
    assert (second.rows_before, second.rows_after, second.rows_lost) == (1, 0, 1)
    assert not second.has_duplicates


def test_source_coverage(spark):
    frames = {"clickstream": keyed(spark, [(S1, "a"), (S1, "b")]), "lms": keyed(spark, [(S1, "b"), (S1, "c"), (S1, None)])}
    (row,) = source_coverage(frames).collect()
    assert (row.customers_clickstream, row.customers_lms) == (2, 2)
    assert (row.customers_in_all, row.customers_in_any) == (1, 3)


def test_sources_present(spark):
    frames = {"clickstream": keyed(spark, [(S1, "a"), (S2, "a")]), "lms": keyed(spark, [(S2, "b")])}
    assert rows(sources_present(frames)) == [(S1, 1), (S2, 9)]


@pytest.mark.parametrize("values, bins", [([0, 3, 3, 7, 31, 60, 100], 50), (list(range(61)), 30), ([5, 5], 4)])
def test_histogram_agrees_with_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "dpd int")
    got = equal_width_histogram(df, "dpd", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r.n_obs for r in got] == counts.tolist()
    assert np.allclose([r.bin_start for r in got], edges[:-1])
    assert np.allclose([r.bin_end for r in got], edges[1:])


def test_histogram_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "dpd int")
    got = equal_width_histogram(df, "dpd", 3).collect()
    assert [(r.n_obs, r.bin_start) for r in got] == [(0, None)] * 3


def test_exceedance(spark):
    df = spark.createDataFrame([(0,), (10,), (30,), (None,)], "dpd int")
    assert rows(exceedance(df, "dpd", [10, 30])) == [(10, 4, 2, 2, 50.0), (30, 4, 1, 3, 25.0)]
