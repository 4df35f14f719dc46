"""Backfill a lake from a folder of raw CSV files.

    python -m loanstrata --raw data --lake lake --start 2023-01-01 --end 2024-12-01
"""

from __future__ import annotations

import argparse
from datetime import date

from loanstrata.functions.dates import month_starts
from loanstrata.plans.backfill import backfill, export_silver, load_analysis, load_customers, load_metrics
from loanstrata.plans.customers import counted_summary
from loanstrata.plans.quality import store_summary
from loanstrata.session import builder
from loanstrata.sources.lake import Lake
from loanstrata.sources.raw import read_raw_sources


def main() -> None:
    parser = argparse.ArgumentParser(prog="loanstrata", description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of the four raw CSV files")
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--start", default="2023-01-01")
    parser.add_argument("--end", default="2024-12-01")
    parser.add_argument("--dpd", type=int, default=30, help="days past due that make a loan bad")
    parser.add_argument("--mob", type=int, default=6, help="months on book of the label")
    parser.add_argument("--on-missing", choices=["skip", "strict"], default="skip")
    parser.add_argument("--months-per-job", type=int, help="clean the months in groups of this size")
    parser.add_argument("--shuffle-partitions", type=int, help="bytes a job shuffles / 128 MB")
    parser.add_argument(
        "--buckets", type=int, default=0, help="deal silver by customer: bytes of silver / snapshots a job / 128 MB"
    )
    parser.add_argument("--report", action="store_true", help="also write run metrics and join audit")
    parser.add_argument("--analysis", action="store_true", help="also write the delinquency tables")
    parser.add_argument("--export", type=date.fromisoformat, help="also export this snapshot's cleaned tables")
    args = parser.parse_args()

    spark = builder(shuffle_partitions=args.shuffle_partitions).getOrCreate()
    lake = Lake(spark, args.lake)
    raw = read_raw_sources(spark, args.raw, checked=True)
    if not raw:
        parser.exit(1, f"no raw file found in {args.raw}\n")
    backfill(
        lake,
        raw,
        args.start,
        args.end,
        args.dpd,
        args.mob,
        args.on_missing,
        args.months_per_job,
        audit=args.report,
        buckets=args.buckets,
    )
    if args.report:
        load_metrics(lake, None, month_starts(args.start, args.end), args.mob)
    if args.analysis:
        load_analysis(lake, args.dpd, args.mob)
        load_customers(lake, args.buckets)
    if args.export:
        export_silver(lake, args.export, f"{args.lake.rstrip('/')}/export/{args.export}")

    stores = {name: lake.read("gold", name) for name in ("label_store", "feature_store")}
    stores = {name: df for name, df in stores.items() if df is not None}
    if stores:
        (counted_summary(lake) if args.analysis else store_summary(stores)).show()
    else:
        print("no store found")


if __name__ == "__main__":
    main()
