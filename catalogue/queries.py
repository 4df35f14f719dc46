"""One query per operator, each over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import views
from loanstrata.functions import numbers, text
from loanstrata.functions.dates import month_calendar, month_starts
from loanstrata.operators.merge import inner_merge, join_audit, source_coverage
from loanstrata.operators.normalize import normalize_names, normalize_strings
from loanstrata.plans import backfill, cube, customers, delinquency, gold, quality, silver
from loanstrata.plans.bronze import bronze_rows, dated
from loanstrata.schemas import FEATURE_INPUTS, FINANCIAL_INTEGERS, FINANCIAL_NUMBERS, LABEL_INPUTS, RAGGED, SOURCES
from loanstrata.sources.lake import Lake, export_csv, read_export
from loanstrata.sources.raw import read_raw

DPD, MOB = 30, 6


def _bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bronze_rows(views.RAW[name](spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.clean(name, _bronze(spark, sf_dir, name))


def _all_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: _silver(spark, sf_dir, name) for name in SOURCES}


def _normal(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Normalised text of every raw row, before deduplication."""
    return normalize_strings(normalize_names(dated(views.RAW[name](spark, sf_dir))))


def _stored_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw views of a query that needs them all: the join that three of them begin with is made once."""
    return views.raw_sources(spark, sf_dir, views.stored_lines(spark, sf_dir, f"{scratch(spark)}/lines"))


def _feature_silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Silver tables with the columns that features need, and those before them."""
    return {n: silver.clean(n, bronze_rows(df), FEATURE_INPUTS[n]) for n, df in raw.items()}


def _features(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: gold.features(n, df, MOB) for n, df in _feature_silver(_stored_raw(spark, sf_dir)).items()}


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delinquency.observations(_silver(spark, sf_dir, "lms"), DPD, views.STARTED_BEFORE)


def scratch(spark: SparkSession) -> str:
    """A fresh folder that all executors share: below the session's checkpoint folder, or its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"


# -- sources, calendar, bronze ---------------------------------------------------------------------


def month_calendar_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months between the first and the last shipment."""
    return month_calendar(views.table(spark, sf_dir, "lineitem"), "l_shipdate")


def bronze_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan rows of the months of one year."""
    months = month_starts("1997-01-01", "1997-12-01")
    return bronze_rows(views.raw_lms(spark, sf_dir), months)


# -- silver ----------------------------------------------------------------------------------------


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir, "attributes")


def dedup_customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.normalize(_bronze(spark, sf_dir, "lms"))


def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "financials")
    return rows.select(
        "customer_id", "snapshot_date", *[numbers.to_number(F.col(c)).alias(c) for c in FINANCIAL_NUMBERS]
    )


def clean_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "financials")
    return rows.select(
        "customer_id", "snapshot_date", *[numbers.to_integer(F.col(c)).alias(c) for c in FINANCIAL_INTEGERS]
    )


def clean_age_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "attributes").select("customer_id", "snapshot_date", "age")
    return silver.repair_age(rows)


def clean_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "attributes")
    return rows.select("customer_id", text.clean_occupation(F.col("occupation")).alias("occupation"))


def clean_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "attributes")
    return rows.select("customer_id", text.collapse_spaces(F.col("name")).alias("name"))


def valid_ssn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "attributes")
    return rows.select("customer_id", text.valid_ssn(F.col("ssn")).alias("ssn"))


def junk_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "financials")
    names = ("payment_behaviour", "credit_mix")
    return rows.select("customer_id", *[text.junk_to_unknown(F.col(c)).alias(c) for c in names])


def credit_history_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "financials")
    years = text.credit_history_years(F.col("credit_history_age"))
    return rows.select("customer_id", years.alias("credit_history_age"))


def loan_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _normal(spark, sf_dir, "financials")
    loans = rows.select("customer_id", text.loan_types(F.col("type_of_loan")).alias("loans"))
    return loans.select(
        "customer_id",
        F.size("loans").alias("num_of_loan"),
        F.array_join("loans", ", ").alias("type_of_loan"),
    )


# -- gold ------------------------------------------------------------------------------------------


def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.label_store(_silver(spark, sf_dir, "lms"), DPD, MOB)


def merged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature frames of the four sources, inner-joined one after the other."""
    return inner_merge(list(_features(spark, sf_dir).values()))


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.feature_store(_feature_silver(_stored_raw(spark, sf_dir)), MOB)


def feature_store_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.feature_store(_feature_silver(_stored_raw(spark, sf_dir)), MOB, on_missing="strict")


def feature_rows_by_source(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: gold.feature_rows(n, df, MOB) for n, df in _all_silver(spark, sf_dir).items()}


# -- quality ---------------------------------------------------------------------------------------


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_metrics(views.raw_sources(spark, sf_dir), _silver(spark, sf_dir, "lms"), MOB)


def store_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = {
        "label_store": label_store(spark, sf_dir),
        "feature_store": feature_store_strict(spark, sf_dir),
    }
    return quality.store_summary(stores)


def preview_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.preview(label_store(spark, sf_dir), ["snapshot_date", "customer_id"], 20)


# -- lake ------------------------------------------------------------------------------------------


def _raw_files(spark: SparkSession, sf_dir: str, root: str, names: list[str]) -> dict[str, DataFrame]:
    """The raw views written as CSV, and read again the way a user's raw files are; compressed, for as text
    they are by far the largest files of a load."""
    for name in names:
        export_csv(views.RAW[name](spark, sf_dir), f"{root}/raw/{SOURCES[name].file_name}", "gzip")
    return {n: read_raw(spark, f"{root}/raw/{SOURCES[n].file_name}") for n in names}


def backfill_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV → bronze → silver → gold for all months, then the feature store as stored."""
    root = scratch(spark)
    lake = Lake(spark, f"{root}/lake")
    raw = _raw_files(spark, sf_dir, root, list(SOURCES))
    backfill.backfill(lake, raw, *views.month_range(spark, sf_dir), DPD, MOB)
    return lake.read("gold", "feature_store")


def backfill_label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV → bronze → silver → labels of the loan table, in two runs of adjacent month ranges."""
    root = scratch(spark)
    lake = Lake(spark, f"{root}/lake")
    raw = _raw_files(spark, sf_dir, root, ["lms"])
    first, last = views.month_range(spark, sf_dir)
    for start, end in ((first, "1998-06-01"), ("1998-07-01", last)):
        months = month_starts(start, end)
        backfill.load_bronze(lake, "lms", raw["lms"], months)
        backfill.load_silver(lake, "lms", months)
        backfill.load_labels(lake, months, DPD, MOB)
    return lake.read("gold", "label_store")


def widened_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: until June 1998 the raw file has two features, then four; the means as stored tables give them."""
    root = scratch(spark)
    lake = Lake(spark, f"{root}/lake")
    raw = _raw_files(spark, sf_dir, root, ["clickstream"])["clickstream"]
    first, last = views.month_range(spark, sf_dir)
    early, late = month_starts(first, "1998-06-01"), month_starts("1998-07-01", last)
    backfill.load_bronze(lake, "clickstream", raw.drop("fe_3", "fe_4"), early)
    backfill.load_bronze(lake, "clickstream", raw, late)
    backfill.load_silver(lake, "clickstream", early + late)
    return gold.features("clickstream", lake.read("silver", "clickstream"))


def stored_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored report of a run over one year: all other rows are off its calendar."""
    root = scratch(spark)
    lake = Lake(spark, f"{root}/lake")
    raw = views.raw_sources(spark, sf_dir)
    months = month_starts("1997-01-01", "1997-12-01")
    backfill.load_bronze(lake, "lms", raw["lms"], months)
    backfill.load_silver(lake, "lms", months)
    backfill.load_report(lake, raw, months, MOB)
    return lake.read("quality", "run_metrics")


def write_that_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored labels, after a rerun with other labels broke off in the rows of its last months."""
    lake = Lake(spark, f"{scratch(spark)}/lake")
    months = month_starts(*views.month_range(spark, sf_dir))
    lms = _silver(spark, sf_dir, "lms")
    lake.write(gold.label_store(lms, DPD, MOB), "gold", "label_store", months)
    breaks = F.when(F.col("snapshot_date") >= F.lit("1998-06-01"), F.raise_error(F.lit("executor lost"))).cast("int")
    try:
        broken = gold.label_store(lms, 1, MOB).withColumn("label", F.coalesce(breaks, "label"))
        lake.write(broken, "gold", "label_store", months)
    except Exception as error:
        if "executor lost" not in str(error):
            raise
    return lake.read("gold", "label_store")


def version_before_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels as they were before a rerun of one year with another threshold."""
    lake = Lake(spark, f"{scratch(spark)}/lake")
    lms = _silver(spark, sf_dir, "lms")
    lake.write(gold.label_store(lms, DPD, MOB), "gold", "label_store", month_starts(*views.month_range(spark, sf_dir)))
    lake.write(gold.label_store(lms, 1, MOB), "gold", "label_store", month_starts("1997-01-01", "1997-12-01"))
    return lake.read("gold", "label_store", version=1)


def counted_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a load of one year, as its writes counted them."""
    lake = Lake(spark, f"{scratch(spark)}/lake")
    raw = views.raw_sources(spark, sf_dir)
    months = month_starts("1997-01-01", "1997-12-01")
    for name in ("lms", "attributes"):
        backfill.load_bronze(lake, name, raw[name], months)
        backfill.load_silver(lake, name, months)
    return quality.counted_metrics(lake, months)


def _silver_lake(spark: SparkSession, sf_dir: str, months: list[date], buckets: int = 0) -> Lake:
    """A lake with the silver tables of these months, each written in jobs of bounded size."""
    lake = Lake(spark, f"{scratch(spark)}/lake")
    rows = views.rows_by_month(spark, sf_dir)
    for name, df in _stored_raw(spark, sf_dir).items():
        for group in backfill.job_groups(months, rows[name]):
            lake.write(silver.clean(name, bronze_rows(df, group)), "silver", name, group, buckets=buckets)
    return lake


def _audited(spark: SparkSession, sf_dir: str) -> Lake:
    """Feature store and join audit of all months, by one shuffle of the silver rows."""
    months = month_starts(*views.month_range(spark, sf_dir))
    lake = _silver_lake(spark, sf_dir, months)
    for group in backfill.job_groups(months, backfill.rows_of_sources(lake, "silver")):
        backfill.load_features(lake, group, MOB, audit=True)
    return lake


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table in which seventh installments lack their last cell and sixth ones have one too many: the
    lines that the load lists, and how many it counted."""
    root = scratch(spark)
    lake = Lake(spark, f"{root}/lake")
    raw = views.raw_lms(spark, sf_dir)
    # the date must be there for a row to be loaded, so the balance comes last
    order = [*[c for c in raw.columns if c != "balance"], "balance"]
    number = F.col("installment_num")
    cells = [F.coalesce(c, F.lit("")) for c in order[:-1]]
    line = F.concat_ws(",", *cells, F.when(number != "7", F.col("balance")), F.when(number == "6", "more"))
    # lines as they are, each file headed by the name of their one column
    plain = {"header": True, "sep": "\1", "quote": "\0", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.select(line.alias(",".join(order))).write.options(**plain).csv(f"{root}/raw")
    months = month_starts(*views.month_range(spark, sf_dir))
    backfill.load_bronze(lake, "lms", read_raw(spark, f"{root}/raw", checked=True), months)
    counted = lake.manifest("bronze", "lms").runs
    ragged = sum(run.measured["rows_ragged"] for run in counted.values())
    lines = lake.read("quarantine", "lms").withColumnRenamed(RAGGED, "line")
    return lines.select("snapshot_date", "line", F.lit(ragged).cast("bigint").alias("rows_ragged"))


def bucketed_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored feature store, from silver tables that were dealt by customer."""
    months = month_starts(*views.month_range(spark, sf_dir))
    lake = _silver_lake(spark, sf_dir, months, buckets=8)
    backfill.load_features(lake, months, MOB)
    return lake.read("gold", "feature_store")


def merged_store_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and customers of the stores from bitmaps, which were made for the first months and then brought
    up to date."""
    lake = Lake(spark, f"{scratch(spark)}/lake")
    raw = _stored_raw(spark, sf_dir)
    lms = silver.clean("lms", bronze_rows(raw["lms"]), LABEL_INPUTS)
    stores = {
        "label_store": gold.label_store(lms, DPD, MOB),
        "feature_store": gold.feature_store(_feature_silver(raw), MOB, on_missing="strict"),
    }
    first, last = views.month_range(spark, sf_dir)
    for start, end in ((first, "1998-06-01"), ("1998-07-01", last)):
        for name, df in stores.items():
            lake.write(df, "gold", name, month_starts(start, end))
        backfill.load_customers(lake, buckets=8)
    return customers.counted_summary(lake)


# -- analysis from the cube ------------------------------------------------------------------------


def _on_cube(report: Callable[[DataFrame], DataFrame]):
    """A report on the cells of the cube of all silver loan rows."""
    return lambda spark, sf_dir: report(
        cube.cells(cube.loan_cube(_silver(spark, sf_dir, "lms")), DPD, views.STARTED_BEFORE)
    )


def incremental_analysis(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A stored table of the analysis, which was made for the first months and then brought up to date."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = Lake(spark, f"{scratch(spark)}/lake")
        lms = _silver(spark, sf_dir, "lms")
        first, last = views.month_range(spark, sf_dir)
        for start, end in ((first, "1998-06-01"), ("1998-07-01", last)):
            lake.write(lms, "silver", "lms", month_starts(start, end))
            backfill.load_analysis(lake, DPD, MOB, views.STARTED_BEFORE)
        return lake.read("analysis", table)

    return query


def csv_export(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Cleaned rows of a source, all columns, written as CSV, compressed as raw files are, and read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch(spark)}/export"
        rows = _silver(spark, sf_dir, name)
        export_csv(rows, path, "gzip")
        return read_export(spark, path, rows.schema)

    return query


def _on_observations(report: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: report(_observations(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "month_calendar": month_calendar_query,
    "bronze_slice": bronze_slice,
    "normalize_text": normalize_text,
    "dedup_customer_snapshot": dedup_customer_snapshot,
    "clean_numeric": clean_numeric,
    "clean_integer": clean_integer,
    "clean_age_median": clean_age_median,
    "clean_occupation": clean_occupation,
    "clean_name": clean_name,
    "valid_ssn": valid_ssn,
    "junk_category": junk_category,
    "credit_history_years": credit_history_years,
    "loan_list": loan_list,
    "lms_delinquency": lambda s, d: _silver(s, d, "lms"),
    "silver_clickstream": lambda s, d: _silver(s, d, "clickstream"),
    "silver_attributes": lambda s, d: _silver(s, d, "attributes"),
    "silver_financials": lambda s, d: _silver(s, d, "financials"),
    "label_store": label_store,
    "clickstream_features": lambda s, d: gold.features("clickstream", _silver(s, d, "clickstream")),
    "attributes_features": lambda s, d: gold.features("attributes", _silver(s, d, "attributes")),
    "financials_features": lambda s, d: gold.features("financials", _silver(s, d, "financials")),
    "lms_features": lambda s, d: gold.features("lms", _silver(s, d, "lms"), MOB),
    "latest_attributes": lambda s, d: gold.latest_records(_silver(s, d, "attributes")),
    "latest_financials": lambda s, d: gold.latest_records(_silver(s, d, "financials"), "1998-06-01"),
    "merged_features": merged_features,
    "feature_store": feature_store,
    "feature_store_strict": feature_store_strict,
    "feature_store_mob8": lambda s, d: gold.feature_store(_feature_silver(_stored_raw(s, d)), mob=8),
    "join_audit": lambda s, d: join_audit(feature_rows_by_source(s, d)),
    "source_coverage": lambda s, d: source_coverage(feature_rows_by_source(s, d)),
    "bad_rate_by_mob": _on_observations(delinquency.bad_rate_by_mob),
    "mob_counts": _on_observations(delinquency.mob_counts),
    "dpd_by_mob": _on_observations(delinquency.dpd_by_mob),
    "mob_profile": _on_observations(delinquency.mob_profile),
    "final_installment": _on_observations(
        lambda obs: delinquency.at_installment(obs, views.FINAL_INSTALLMENT)
    ),
    "actual_bads_last_obs": _on_observations(delinquency.actual_bads),
    "actual_bads_summary": _on_observations(delinquency.actual_bads_summary),
    "dpd_histogram": _on_observations(delinquency.dpd_histogram),
    "dpd_histogram_60": _on_observations(
        lambda obs: delinquency.dpd_histogram(obs, bins=30, at_most=60)
    ),
    "dpd_thresholds": _on_observations(delinquency.dpd_thresholds),
    "default_split_at_mob": _on_observations(lambda obs: delinquency.default_split(obs, MOB)),
    "eda_summary": _on_observations(delinquency.summary),
    "run_metrics": run_metrics,
    "store_summary": store_summary,
    "preview_top_rows": preview_top_rows,
    "backfill_label_store": backfill_label_store,
    "backfill_feature_store": backfill_feature_store,
    "widened_clickstream": widened_clickstream,
    "stored_run_metrics": stored_run_metrics,
    "write_that_fails": write_that_fails,
    "version_before_rerun": version_before_rerun,
    "counted_run_metrics": counted_run_metrics,
    "audited_feature_store": lambda s, d: _audited(s, d).read("gold", "feature_store"),
    "stored_join_audit": lambda s, d: _audited(s, d).read("quality", "join_audit"),
    "quarantined_lines": quarantined_lines,
    "bucketed_feature_store": bucketed_feature_store,
    "merged_store_summary": merged_store_summary,
    "cube_mob_profile": _on_cube(cube.mob_profile),
    "cube_dpd_histogram_60": _on_cube(lambda cells: cube.dpd_histogram(cells, bins=30, at_most=60)),
    "cube_dpd_thresholds": _on_cube(cube.dpd_thresholds),
    "cube_default_split": _on_cube(lambda cells: cube.default_split(cells, MOB)),
    "incremental_eda_summary": incremental_analysis("summary"),
    "incremental_actual_bads": incremental_analysis("actual_bads"),
    "csv_export": csv_export("lms"),
    "csv_export_clickstream": csv_export("clickstream"),
    "csv_export_attributes": csv_export("attributes"),
    "csv_export_financials": csv_export("financials"),
}
