"""Counts from the cube, last observations as a state, counts of the loads, ragged lines, one-shuffle audit."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from catalogue import views
from loanstrata.functions.dates import month_starts
from loanstrata.operators.merge import join_audit
from loanstrata.plans import backfill, cube, delinquency, gold, quality
from loanstrata.plans.silver import clean
from loanstrata.plans.bronze import bronze_rows
from loanstrata.schemas import RAGGED, SOURCES
from loanstrata.sources.lake import Lake
from loanstrata.sources.raw import read_raw, read_raw_sources

SF = "/root/testdata/sf0.001"
YEAR = month_starts("1997-01-01", "1997-12-01")
BEFORE = views.STARTED_BEFORE

LOANS = "loan_id string, snapshot_date date, loan_start_date date, installment_num int, mob int, installments_missed bigint, dpd int"
OLD, D1, D2, D3 = date(1999, 1, 1), date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)
ROWS = [
    ("a", D1, OLD, 1, 1, 0, 0),
    ("a", D2, OLD, 2, 2, 2, 31),
    ("b", D1, OLD, 1, 1, 9, None),  # days beyond the date range: past due
    ("b", D2, OLD, 2, 2, 0, None),  # overdue with nothing due: unknown
    ("c", D1, date(2024, 5, 1), 1, 1, 1, 90),  # started too late
    ("c", D2, None, 1, 1, 1, 90),
    (None, D3, OLD, 6, 6, 1, 60),
    ("d", D3, OLD, None, None, 0, 5),
    ("e", D2, OLD, 3, 6, 1, 90),
    ("e", D2, OLD, 3, 6, 1, 20),
]


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    columns = sorted(a.columns)
    assert sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


@pytest.fixture(scope="module")
def lms(spark):
    return clean("lms", bronze_rows(views.raw_lms(spark, SF), YEAR)).cache()


@pytest.mark.parametrize("dpd", [1, 30, 90])
def test_cube_counts_what_the_rows_count(spark, lms, dpd):
    for loans in (lms, spark.createDataFrame(ROWS, LOANS)):
        for before in ("2000-01-01", BEFORE, "2024-12-01"):
            obs = delinquency.observations(loans, dpd, before)
            cells = cube.cells(cube.loan_cube(loans), dpd, before)
            found = cube.count_tables(cells, delinquency.last_observation(obs))
            direct = delinquency.tables(obs.drop("dpd_flag"), dpd, 6, before)
            for name in ("mob_profile", "dpd_thresholds", "default_split", "summary", "dpd_histogram"):
                same(found[name], direct[name])


def test_cubes_of_snapshots_add_up(spark):
    loans = spark.createDataFrame(ROWS, LOANS)
    parts = cube.loan_cube(loans.where("snapshot_date < '2023-02-01'")).unionByName(
        cube.loan_cube(loans.where("snapshot_date >= '2023-02-01'"))
    )
    same(parts, cube.loan_cube(loans))
    assert sum(r.n for r in parts.collect()) == len(ROWS)
    none = cube.cells(cube.loan_cube(loans.limit(0)))
    assert cube.mob_profile(none).isEmpty()
    assert cube.dpd_thresholds(none).first().n_obs == 0


def test_stored_analysis_is_brought_up_to_date(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    loans = spark.createDataFrame(ROWS, LOANS)

    def check(seen, dpd=30):
        backfill.load_analysis(lake, dpd, 6, "2024-01-01")
        for name, df in delinquency.tables(seen, dpd).items():
            if name != "final_installment":
                same(lake.read("analysis", name), df)

    lake.write(loans, "silver", "lms", [D1])
    check(loans.where(F.col("snapshot_date") == D1))
    assert backfill.refresh_cube(lake) == [] and backfill.refresh_last_observations(lake) == []
    lake.write(loans, "silver", "lms", [D2, D3])
    assert backfill.refresh_last_observations(lake) == [D2, D3]
    check(loans)
    # a month is written again: its cells are replaced, and the state is made anew
    changed = loans.where("loan_id = 'a'").withColumn("dpd", F.lit(95))
    lake.write(changed, "silver", "lms", [D2])
    now = loans.where(F.col("snapshot_date") != D2).unionByName(changed.where(F.col("snapshot_date") == D2))
    assert backfill.refresh_cube(lake) == [D2]
    assert backfill.refresh_last_observations(lake) == [D1, D2, D3]
    check(now)
    # another threshold asks for another state, but not for another cube
    check(now, dpd=91)
    # a month without rows any more
    lake.write(loans.limit(0), "silver", "lms", [D3])
    check(now.where(F.col("snapshot_date") != D3))


def test_state_equals_a_full_run(spark, lms):
    obs = delinquency.observations(lms, 30, BEFORE)
    state = None
    for first in range(0, 12, 5):
        state = cube.merged_last(state, obs.where(F.col("snapshot_date").isin(YEAR[first : first + 5]))).cache()
    same(state, delinquency.last_observation(obs))


def test_counts_of_a_load(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = [("a", "2023-01-01"), ("a", "2023-01-01"), ("b", "2023-01-01"), ("c", "2023-02-01"), ("d", "soon"), ("e", "2020-01-01")]
    raw = spark.createDataFrame(rows, "customer_id string, snapshot_date string")
    backfill.load_bronze(lake, "attributes", raw, [D1, D2, D3])
    backfill.load_silver(lake, "attributes", [D1, D2, D3])
    counted = {(r.snapshot_date, r.metric): r.value for r in quality.counted_metrics(lake, [D1, D2, D3]).collect()}
    assert counted == {
        (D1, "rows_loaded"): 3, (D1, "rows_kept"): 2, (D1, "duplicates_removed"): 1,
        (D2, "rows_loaded"): 1, (D2, "rows_kept"): 1, (D2, "duplicates_removed"): 0,
        (None, "rows_unreadable"): 1, (None, "rows_off_calendar"): 1,
    }
    assert list(lake.manifest("bronze", "attributes").runs.values())[0].measured["rows_loaded"] == 6
    # silver that was made from an older bronze says nothing about the new one
    backfill.load_bronze(lake, "attributes", raw.limit(1), [D1])
    counted = {(r.snapshot_date, r.metric): r.value for r in quality.counted_metrics(lake, [D1]).collect()}
    assert counted == {(D1, "rows_loaded"): 1, (None, "rows_unreadable"): 0, (None, "rows_off_calendar"): 0}


def test_the_report_of_a_load_reads_no_raw_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    raw = {"lms": views.raw_lms(spark, SF)}
    backfill.backfill(lake, raw, "1997-01-01", "1997-02-01", audit=True)
    backfill.load_metrics(lake, None, YEAR[:2])
    counted = {(r.snapshot_date, r.metric): r.value for r in lake.read("quality", "run_metrics").collect()}
    full = {(r.snapshot_date, r.metric): r.value for r in quality.bronze_metrics(raw, YEAR[:2]).collect()}
    for day in YEAR[:2]:
        for metric in ("rows_loaded", "rows_kept", "duplicates_removed"):
            assert counted[day, metric] == full[day, metric]
    others = sum(n for (day, metric), n in full.items() if metric == "rows_off_calendar")
    assert counted[None, "rows_off_calendar"] == others > 0
    assert counted[YEAR[0], "rows_at_mob"] == lake.read("gold", "label_store", YEAR[:1]).count()


def test_ragged_lines_are_listed_and_loaded(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / SOURCES["attributes"].file_name).write_text(
        "Customer_ID,snapshot_date,Age,Name\n"
        "a,2023-01-01,20,x\nb,2023-01-01,21\nc,2023-01-01,22,y,more\n\nd,soon\n\"e\",2023-02-01,\"1,2\",z\n"
    )
    plain, checked = (read_raw_sources(spark, str(raw), checked=c)["attributes"] for c in (False, True))
    same(checked.drop(RAGGED), plain)
    lake = Lake(spark, str(tmp_path / "lake"))
    backfill.load_bronze(lake, "attributes", checked, [D1, D2])
    assert lake.read("bronze", "attributes").columns == ["Customer_ID", "Age", "Name", "snapshot_date"]
    assert sorted((r.Customer_ID, r.Name) for r in lake.read("bronze", "attributes").collect()) == [
        ("a", "x"), ("b", None), ("c", "y"), ("e", "z"),
    ]
    listed = {(r.snapshot_date, r[RAGGED]) for r in lake.read("quarantine", "attributes").collect()}
    assert listed == {(D1, "b,2023-01-01,21"), (D1, "c,2023-01-01,22,y,more"), (None, "d,soon")}
    counted = {r.metric: r.value for r in quality.counted_metrics(lake, [D1]).collect() if r.snapshot_date is None}
    assert counted == {"rows_unreadable": 1, "rows_off_calendar": 0, "rows_ragged": 3}
    # the file is mended
    backfill.load_bronze(lake, "attributes", checked.where("Customer_ID in ('a', 'e')"), [D1, D2])
    assert lake.read("quarantine", "attributes").isEmpty()
    bad = tmp_path / "bad.csv"
    bad.write_text(f"a,{RAGGED}\n1,2\n")
    with pytest.raises(ValueError, match="of its own"):
        read_raw(spark, str(bad), checked=True)


def test_store_and_audit_of_one_shuffle(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    silver = {n: clean(n, bronze_rows(views.RAW[n](spark, SF), YEAR[:3])) for n in SOURCES}
    # a customer of no name, a customer with several rows, a month without clickstream
    silver["attributes"] = silver["attributes"].unionByName(silver["attributes"].limit(3).withColumn("customer_id", F.lit(None).cast("string")))
    silver["financials"] = silver["financials"].unionByName(silver["financials"].limit(5))
    silver["clickstream"] = silver["clickstream"].where(F.col("snapshot_date") != YEAR[1])
    for name, df in silver.items():
        lake.write(df, "silver", name, YEAR[:3])
    stored = {n: lake.read("silver", n) for n in SOURCES}
    for on_missing in ("skip", "strict"):
        backfill.load_features(lake, YEAR[:3], 6, on_missing, audit=True)
        same(lake.read("gold", "feature_store"), gold.feature_store(stored, 6, on_missing))
        same(lake.read("quality", "join_audit"), join_audit(gold.rows_by_source(stored, 6), on_missing))
    rows = gold.rows_by_source(stored, 6)
    text = gold.customer_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    together = lake.read("gold", "customer_rows")
    for df in (gold.store_of(together, list(rows)), gold.audit_of(together, list(rows))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(customer_id" not in plan and "SortMergeJoin" not in plan
    with pytest.raises(ValueError, match="on_missing"):
        gold.store_of(together, list(rows), "maybe")


def test_audit_with_missing_sources(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    backfill.load_features(lake, YEAR[:1], audit=True)
    assert lake.read("gold", "feature_store") is None
    lake.write(clean("attributes", bronze_rows(views.RAW["attributes"](spark, SF), YEAR[:1])), "silver", "attributes", YEAR[:1])
    backfill.load_features(lake, YEAR[:1], audit=True)
    assert lake.read("quality", "join_audit") is None
    same(lake.read("gold", "feature_store"), gold.feature_store({"attributes": lake.read("silver", "attributes")}))
    backfill.load_features(lake, YEAR[5:6], audit=True)
    assert lake.read("gold", "feature_store", YEAR[5:6]).isEmpty()
