"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution sizes shuffle partitions, splits skewed ones and rebalances writes.
    "spark.sql.adaptive.enabled": "true",
    # With more than 2000 partitions Spark keeps the mean size of a map task's blocks, which hides a hot
    # partition from the skew handling. Blocks of five times the median keep their own size.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    # The financial cleaner fills a large generated method, and the JIT compiles none beyond 8000
    # bytes of code. With this limit Spark splits the expressions into small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def builder(
    app_name: str = "loanstrata", shuffle_partitions: int | None = None
) -> SparkSession.Builder:
    """A session builder with these settings; master and resources are the caller's.

    ``shuffle_partitions`` is the number AQE starts from and merges down: about the bytes one job
    shuffles divided by 128 MB. Without it AQE starts from 4096, enough for some 500 GB a job.
    """
    build = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        build = build.config(key, value)
    if shuffle_partitions:
        return build.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # AQE merges partitions that are too small, but never splits those of an aggregate.
    return build.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4096")
