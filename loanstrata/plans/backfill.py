"""Build the lake for a range of months: bronze, silver, label store, feature store."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loanstrata.functions.dates import month_starts
from loanstrata.operators.merge import join_audit
from loanstrata.operators.normalize import normal_name
from loanstrata.plans import cube, customers
from loanstrata.plans.bronze import dated
from loanstrata.plans.delinquency import DEFAULT_MOB, at_installment, observations
from loanstrata.plans.gold import audit_of, customer_rows, feature_store, label_store, rows_by_source, store_of
from loanstrata.plans.quality import bronze_metrics, counted_metrics, lms_metrics, scan_counts
from loanstrata.plans.silver import clean
from loanstrata.schemas import RAGGED, SNAPSHOT, SOURCE_COLUMNS, SOURCES, source
from loanstrata.sources.lake import Lake, export_csv


#: Rows that jobs running at the same time take by default: what these shuffle and spill lies on the executors'
#: disks until they end.
ROWS_PER_JOB = 2**27


def job_groups(snapshots: Sequence[date], rows: Mapping[date, int], most: int | None = None) -> list[list[date]]:
    """The snapshots in order, in groups that have at most ``most`` rows, by default `ROWS_PER_JOB`; a snapshot
    that has more is a group of its own. Small tables are one group."""
    most, groups, held = most or ROWS_PER_JOB, [[]], 0
    for day in snapshots:
        n = rows.get(day, 0)
        if held and held + n > most:
            groups.append([])
            held = 0
        groups[-1].append(day)
        held += n
    return groups


def rows_of_sources(lake: Lake, layer: str) -> dict[date, int]:
    """The rows that each snapshot has in all sources together, from the manifests; reads no data."""
    found: dict[date, int] = {}
    for name in SOURCES:
        for day, n in lake.rows(layer, name).items():
            found[day] = n + found.get(day, 0)
    return found


def _side_by_side(lake: Lake, jobs: Iterable[Callable[[], None]]) -> None:
    """Run independent Spark jobs at the same time, so one source's last tasks leave no core idle."""
    jobs = list(jobs)
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        runs = [pool.submit(inheritable_thread_target(lake.spark)(job)) for job in jobs]
        for run in runs:
            run.result()


def load_bronze(
    lake: Lake, name: str, raw: DataFrame, snapshots: list[date], rebalance: bool = True
) -> None:
    """Write the bronze slices of one source, reading the raw table once.

    Clickstream rows name the ``fe_*`` columns of their raw file, which may differ between runs. Pass
    ``rebalance=False`` for raw tables that come sorted by snapshot in well-sized files.

    What the scan reads is counted on the way and kept with the run (`quality.scan_counts`). Of a
    checked scan (`read_raw`) the lines with too many or too few cells are also listed in the table
    ``quarantine/<source>``; they stay in bronze as they were read. That takes a second scan where
    there are any.
    """
    rows = dated(raw)
    counts = scan_counts(rows, snapshots)
    seen = Observation()
    scanned = rows.observe(seen, *[c.alias(n) for n, c in counts.items()])
    kept = scanned.where(F.col(SNAPSHOT).isin(list(snapshots))).drop(RAGGED)
    if source(name).name == "clickstream":
        names = sorted(n for c in raw.columns if (n := normal_name(c)).startswith("fe_"))
        kept = kept.withColumn(SOURCE_COLUMNS, F.lit(",".join(names)))

    def measured(written: dict[date, int]) -> dict:
        found = {n: seen.get[n] for n in counts}
        left_out = found["rows_unreadable"] + found["rows_off_calendar"]
        if found["rows_loaded"] - left_out != sum(written.values()):
            # a lost executor's tasks ran again and were counted twice: count anew
            found = rows.agg(*[c.alias(n) for n, c in counts.items()]).first().asDict()
        if found.get("rows_ragged") or RAGGED in raw.columns and lake.manifest("quarantine", name):
            ragged = rows.where(F.col(RAGGED).isNotNull()).select(SNAPSHOT, RAGGED)
            lake.replace(ragged, "quarantine", name)
        return found

    lake.write(kept, "bronze", name, snapshots, rebalance, measured)


def load_silver(
    lake: Lake, name: str, snapshots: list[date], rebalance: bool = True, buckets: int = 0
) -> None:
    """Clean the bronze slices of one source; a source without bronze is left out.

    With ``buckets`` the rows are dealt by customer (see `Lake.write`): with the same number for all
    sources, `load_features` and `load_report` bring customers together without an exchange.
    """
    runs = lake.runs("bronze", source(name).name)
    rows = lake.read("bronze", name, snapshots)
    if rows is not None:
        made = {"made_from": runs}
        lake.write(clean(name, rows), "silver", name, snapshots, rebalance, lambda _: made, buckets)


def load_labels(lake: Lake, snapshots: list[date], dpd: int = 30, mob: int = 6) -> None:
    """Write the label store; without a silver loan table nothing is written."""
    lms = lake.read("silver", "lms", snapshots)
    if lms is not None:
        lake.write(label_store(lms, dpd, mob), "gold", "label_store", snapshots)


def _silver_by_customer(lake: Lake, opened: ExitStack, snapshots: list[date]) -> dict[str, DataFrame | None]:
    """The silver tables, with the buckets they were written in; to be read while ``opened`` is open."""
    return {n: opened.enter_context(lake.by_customer("silver", n, snapshots)) for n in SOURCES}


def load_features(
    lake: Lake,
    snapshots: list[date],
    mob: int = 6,
    on_missing: str = "skip",
    rebalance: bool = True,
    audit: bool = False,
) -> None:
    """Write the feature store from the silver tables there are.

    With ``audit`` the join audit of the quality layer is written, too: one shuffle brings the rows of a
    customer together for both, its result is written as ``gold/customer_rows``, and store and audit are
    read from there. There is no such shuffle where silver was dealt by customer.
    """
    with ExitStack() as opened:
        silver = _silver_by_customer(lake, opened, snapshots)
        rows = rows_by_source(silver, mob)
        if not rows:
            return
        if not audit:
            store = feature_store(silver, mob, on_missing)
            lake.write(store, "gold", "feature_store", snapshots, rebalance)
            return
        lake.write(customer_rows(rows), "gold", "customer_rows", snapshots, rebalance)
    together = lake.read("gold", "customer_rows", snapshots)
    # without a row in any source there is nothing to store and nothing to audit
    if together is None:
        together = lake.spark.createDataFrame([], customer_rows(rows).schema)
    # the files are well-sized already
    lake.write(store_of(together, list(rows), on_missing), "gold", "feature_store", snapshots, rebalance=False)
    if len(rows) > 1:
        lake.write(audit_of(together, list(rows), on_missing), "quality", "join_audit", snapshots)


def load_report(
    lake: Lake,
    raw: dict[str, DataFrame] | None,
    snapshots: list[date],
    mob: int = 6,
    on_missing: str = "skip",
) -> None:
    """Write the run metrics and the join audit of a run as tables of the quality layer.

    With ``raw`` the metrics count the raw tables, so rows that the run leaves out because of their date
    are in them, date by date. Without it they are the counts that the loads kept, and no raw table is
    read again (`quality.counted_metrics`). The table is that of the last run. The audit is that of the
    frames the store joins.
    """
    load_metrics(lake, raw, snapshots, mob)
    with ExitStack() as opened:
        rows = rows_by_source(_silver_by_customer(lake, opened, snapshots), mob)
        if len(rows) > 1:
            lake.write(join_audit(rows, on_missing), "quality", "join_audit", snapshots)


def load_metrics(lake: Lake, raw: dict[str, DataFrame] | None, snapshots: list[date], mob: int = 6) -> None:
    """Write the run metrics, see `load_report`."""
    found = [bronze_metrics(raw, snapshots) if raw else counted_metrics(lake, snapshots)]
    lms = lake.read("silver", "lms", snapshots)
    if lms is not None:
        found.append(lms_metrics(lms, mob))
    lake.replace(reduce(DataFrame.unionAll, found), "quality", "run_metrics")


def refresh_cube(lake: Lake) -> list[date]:
    """Count the snapshots of the silver loan table that changed since they were counted; returns these."""
    runs, counted = lake.runs("silver", "lms"), lake.made_from("analysis", "loan_cube")
    changed = [date.fromisoformat(k) for k in sorted(runs.keys() | counted.keys()) if runs.get(k) != counted.get(k)]
    if changed:
        cells = cube.loan_cube(lake.read("silver", "lms", changed))
        lake.write(cells, "analysis", "loan_cube", changed, measured=lambda _: {"made_from": runs})
    return changed


def refresh_last_observations(lake: Lake, dpd: int = 30, started_before: str = "2024-01-01") -> list[date]:
    """Bring the last observation of each loan up to date; returns the snapshots that were read for it.

    Snapshots that came since are merged with the state. If one that the state has seen was written
    again, or the state was made with other parameters, it is made anew from all snapshots.
    """
    runs = lake.runs("silver", "lms")
    manifest = lake.manifest("analysis", "last_observation")
    seen = list(manifest.runs.values())[-1].measured if manifest else {}
    had = seen.get("made_from", {})
    asked = {"dpd": dpd, "started_before": started_before}
    holds = {k: seen.get(k) for k in asked} == asked and had.items() <= runs.items()
    new = [date.fromisoformat(k) for k in runs if not holds or k not in had]
    if new or not holds:
        state = lake.read("analysis", "last_observation") if holds else None
        obs = observations(lake.read("silver", "lms", new), dpd, started_before)
        lake.replace(cube.merged_last(state, obs), "analysis", "last_observation", asked | {"made_from": runs})
    return new


def load_analysis(
    lake: Lake, dpd: int = 30, mob: int = DEFAULT_MOB, started_before: str = "2024-01-01"
) -> None:
    """Write the delinquency tables of the stored silver loan table.

    All counts come from the cube, all last observations from the state; of the loan table only the
    snapshots are read that are new to them, and the rows of the final installment.
    """
    lms = lake.read("silver", "lms")
    if lms is None:
        return
    _side_by_side(lake, [lambda: refresh_cube(lake), lambda: refresh_last_observations(lake, dpd, started_before)])
    last = lake.read("analysis", "last_observation")
    found = cube.count_tables(cube.cells(lake.read("analysis", "loan_cube"), dpd, started_before), last, mob)
    found |= {
        "final_installment": at_installment(observations(lms, dpd, started_before)),
        "actual_bads": last.where(F.col("dpd_flag") == 1),
        "actual_bads_summary": cube.bads_summary(last),
    }
    _side_by_side(lake, [lambda n=n, df=df: lake.replace(df, "analysis", n) for n, df in found.items()])


def load_customers(lake: Lake, buckets: int = 0) -> None:
    """Bring the customer bitmaps of both stores up to date: `customers.counted_summary` counts them.

    ``buckets`` deals the numbers of the customers, so that only new rows are shuffled to find theirs.
    """
    for store in customers.STORES:
        customers.refresh_customers(lake, store, buckets)


def export_silver(lake: Lake, snapshot: date, folder: str) -> list[str]:
    """Write the cleaned tables of one snapshot as CSV folders, all columns; the names of those there are."""
    found = {name: lake.read("silver", name, [snapshot]) for name in SOURCES}
    found = {name: df for name, df in found.items() if df is not None}
    for name, df in found.items():
        export_csv(df, f"{folder.rstrip('/')}/{name}")
    return list(found)


def backfill(
    lake: Lake,
    raw: dict[str, DataFrame],
    start: date | str,
    end: date | str,
    dpd: int = 30,
    mob: int = 6,
    on_missing: str = "skip",
    months_per_job: int | None = None,
    rebalance: bool = True,
    audit: bool = False,
    buckets: int = 0,
) -> None:
    """Rebuild all layers for the months from ``start`` to ``end``.

    The raw tables are read once, one after the other, so that the disks hold the shuffle of one of them.
    Silver and gold are one job per table and group of months. A group has at most `ROWS_PER_JOB` rows of all
    sources, or ``months_per_job`` months: that bounds what its jobs shuffle. ``rebalance=False`` writes every layer as its tasks hold it (see `Lake.write`). ``audit`` writes
    the join audit with the feature store (see `load_features`). ``buckets`` deals silver by customer, so
    that gold needs no exchange by customer (see `load_silver`). Every layer is a written table, so a lost executor costs the tasks it ran and a failed run
    can be started again: it overwrites the same snapshots and no others.
    """
    months = month_starts(start, end)
    for name, df in raw.items():
        load_bronze(lake, name, df, months, rebalance)
    if months_per_job:
        groups = [months[i : i + months_per_job] for i in range(0, len(months), months_per_job)]
    else:
        groups = job_groups(months, rows_of_sources(lake, "bronze"))
    for group in groups:
        _side_by_side(lake, [lambda n=n: load_silver(lake, n, group, rebalance, buckets) for n in SOURCES])
        _side_by_side(
            lake,
            [
                lambda: load_labels(lake, group, dpd, mob),
                lambda: load_features(lake, group, mob, on_missing, rebalance, audit),
            ],
        )
