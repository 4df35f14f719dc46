"""Random text and random tables against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from datetime import date
from statistics import median

from pyspark.sql import functions as F

from loanstrata.functions import numbers, text
from loanstrata.operators.dedup import keep_one
from loanstrata.operators.merge import join_audit
from loanstrata.plans import gold
from loanstrata.plans.silver import repair_age
from loanstrata.schemas import FEATURE_STORE, KEYS, SOURCES

RANDOM = random.Random(20240601)


def words(pieces, n=400, longest=8):
    texts = ["".join(RANDOM.choices(pieces, k=RANDOM.randint(0, longest))) for _ in range(n)]
    return [*dict.fromkeys(texts), None]


def compare(spark, function, python, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", function(F.col("v")).alias("r")).collect()
    wrong = {values[r.i]: (r.r, python(values[r.i])) for r in rows if r.r != python(values[r.i])}
    assert not wrong, dict(list(wrong.items())[:5])


def loan_list(value):
    items = [item.strip(" ") for item in (value or "").replace(" and ", ", ").split(",")]
    return list(dict.fromkeys(item for item in items if item))


def test_loan_lists(spark):
    compare(spark, text.loan_types, loan_list, words([" and ", ",", " ", "auto", "home loan", "and", "x"]))


def occupation(value):
    kept = re.sub(r"\W", "", value or "", flags=re.ASCII)
    return re.sub("_{2,}", "_", kept).strip("_") or "unknown"


def test_occupations(spark):
    compare(spark, text.clean_occupation, occupation, words(["a", "_", "__", " ", "-", "é", "9", "\t"]))


def number(value):
    if value and re.fullmatch(r"-?\d*\.?\d+(e[+-]?\d+)?", value):
        return float(value)
    found = re.search(r"-?\d*\.?\d+", re.sub(r"[^\d.\-]", "", value or ""))
    return float(found.group()) if found else 0.0


def test_numbers(spark):
    compare(spark, numbers.to_number, number, words(["1", "23", "0", ".", "-", "_", "e", "x"]))


def integer(value):
    digits = re.sub(r"[^\d.]", "", value or "").split(".")[0]
    whole = int(digits or 0)
    return whole if whole < 2**31 else None


def test_integers(spark):
    compare(spark, numbers.to_integer, integer, words(["1", "23", "0", ".", "-", "_", "98765"]))


def test_keep_one(spark):
    rows = [
        (RANDOM.choice("ab"), RANDOM.choice([None, "x", "y"]), RANDOM.choice([None, 1, 2]), RANDOM.randint(0, 3))
        for _ in range(200)
    ]
    df = spark.createDataFrame(rows, "k string, s string, a int, b int").repartition(5)
    groups = defaultdict(list)
    for k, s, a, b in rows:
        groups[k, s].append((a, b))
    want = {
        key: min(group, key=lambda row: [(v is not None, v) for v in row]) for key, group in groups.items()
    }
    got = {(r.k, r.s): (r.a, r.b) for r in keep_one(df, ["k", "s"]).collect()}
    assert got == want


def test_ages(spark):
    rows = [
        (date(2023, RANDOM.randint(1, 6), 1), f"c{i}", str(RANDOM.choice(["", "x", -5, 0, 20, 33, 120, 121, "47_"])))
        for i in range(150)
    ]
    valid = defaultdict(list)
    for snapshot, _, age in rows:
        if integer(age) and integer(age) <= 120:
            valid[snapshot].append(integer(age))
    want = {
        customer: float(integer(age))
        if integer(age) and integer(age) <= 120
        else float(median(valid[snapshot]) if valid[snapshot] else 30)
        for snapshot, customer, age in rows
    }
    df = spark.createDataFrame(rows, "snapshot_date date, customer_id string, age string")
    assert {r.customer_id: r.age for r in repair_age(df).collect()} == want


def test_feature_store(spark):
    """Sources with random gaps: whole snapshots missing, customers missing, all missing."""
    snapshots = [date(2023, m, 1) for m in range(1, 13)]
    keys = {
        name: [
            (c, s)
            for s in snapshots
            if RANDOM.random() < 0.8
            for c in "abcdefgh"
            if RANDOM.random() < 0.7
        ]
        for name in SOURCES
    }
    shape = "customer_id string, snapshot_date date"

    def frame(name, columns, *values):
        return spark.createDataFrame([(*k, *values) for k in keys[name]], f"{shape}, {columns}")

    silver = {
        "clickstream": frame("clickstream", "fe_1 double", 1.0),
        "attributes": frame("attributes", "age double, occupation string", 30.0, "o"),
        "financials": frame(
            "financials",
            "annual_income double, outstanding_debt double, monthly_inhand_salary double,"
            " total_emi_per_month double, monthly_balance string, credit_history_age double",
            *(2.0, 1.0, 2.0, 1.0, "1", 3.0),
        ),
        "lms": frame(
            "lms",
            "loan_start_date date, installment_num int, mob int, overdue_amt double, due_amt double",
            *(date(2022, 1, 1), 6, 6, 0.0, 1.0),
        ),
    }
    by_snapshot = {n: defaultdict(set) for n in SOURCES}
    for name, pairs in keys.items():
        for c, s in pairs:
            by_snapshot[name][s].add(c)
    skip, strict = set(), set()
    for s in snapshots:
        customers = [by_snapshot[n][s] for n in SOURCES]
        needed = [by_snapshot[n][s] for n in SOURCES if by_snapshot[n][s] or n in ("attributes", "financials")]
        skip |= {(c, s) for c in set.intersection(*needed)}
        strict |= {(c, s) for c in set.intersection(*customers)}

    store = gold.feature_store(silver).collect()
    assert {(r.customer_id, r.snapshot_date) for r in store} == skip and len(store) == len(skip)
    columns = {"clickstream": "clickstream_total_mean", "attributes": "age_group", "lms": "mob"}
    for r in store:
        for name, column in columns.items():
            assert (r[column] is not None) == (r.customer_id in by_snapshot[name][r.snapshot_date])
    last = {}
    for r in join_audit(gold.rows_by_source(silver)).orderBy("step").collect():
        last[r.snapshot_date] = r.rows_after
    per_snapshot = Counter(s for _, s in skip)
    assert {s: n for s, n in last.items() if n} == per_snapshot
    found = gold.feature_store(silver, on_missing="strict")
    last = {}
    for r in join_audit(gold.rows_by_source(silver), "strict").orderBy("step").collect():
        last[r.snapshot_date] = r.rows_after
    assert {s: n for s, n in last.items() if n} == Counter(s for _, s in strict)
    assert found.columns == list(FEATURE_STORE)
    assert {(r.customer_id, r.snapshot_date) for r in found.select(*KEYS).collect()} == strict
