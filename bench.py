"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from catalogue.queries import QUERIES
from loanstrata.session import builder

HEADLINE = [
    "lms_delinquency",
    "silver_clickstream",
    "silver_attributes",
    "silver_financials",
    "label_store",
    "feature_store",
    "merged_features",
    "join_audit",
    "run_metrics",
    "mob_profile",
    "actual_bads_summary",
    "dpd_histogram",
    "backfill_feature_store",
]


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        builder("loanstrata-bench", shuffle_partitions=int(cpus))
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loanstrata-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds(spark, sf_dir, "label_store")  # starts the JVM's compilers before anything is timed
    times = {
        name: round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
        for name in names
    }
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
