"""Sharding: proportional stratified interleaving, every shard a cut of the whole mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shard(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
    buckets: int = 4096,
    spread: bool = False,
) -> DataFrame:
    """Deal rows into shards of the same mixture: (doc_id, size, text_crc32, shard, slot).

    Within a source, rows get the order of a seeded hash. Row r of n gets the fraction (2r + 1) / 2n;
    all rows sorted by fraction, then source, are cut into ``shards`` runs whose lengths differ by at
    most one. So a source with a share x of the rows has that share, up to rounding, in every run. With
    ``spread`` the fraction is (r + u) / n, u from 0 to 1 by a hash of the source: then sources of one row,
    or of any other number that many have, lie all over the runs instead of at the same fractions, where
    they would be one run's mixture and one task's range.

    No group is sorted whole. Hash and fraction are cut into ``buckets`` ranges; counts per (source,
    range) and per range give each range its offset, and only rows inside a range are sorted. A
    source with a third of the rows is spread over all ranges. More than some 1e11 rows want more
    ranges; at most ``buckets`` rows per source, and ``buckets`` in all, meet in an offset sum.

    ``size`` is the bytes of the text in UTF-8 plus 16; ``text_crc32`` is their CRC-32. A null text
    counts as empty. A null source is a source of its own. Rows of equal id, text and source are
    interchangeable and get places of their own. Other columns aren't read; an empty table gives none.
    """
    binary = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        # never null, so that joins and windows share one shuffle
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("source"),
        (F.octet_length(binary) + 16).cast("long").alias("size"),
        F.crc32(binary).alias("text_crc32"),
    )
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")).withColumn(
        # the upper half of a signed hash, in ranges of equal width
        "b",
        F.floor((F.shiftright("h", 32) + F.lit(2**31)) * buckets / F.lit(2**32)).cast("int"),
    )

    shift = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "source"), 11) / F.lit(2.0**53) if spread else F.lit(0.5)
    per_bucket = rows.groupBy("source", "b").agg(F.count("*").alias("n"))
    within = Window.partitionBy("source")
    offsets = per_bucket.select(
        "source",
        "b",
        F.sum("n").over(within.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.sum("n").over(within).alias("n_source"),
    )
    in_bucket = Window.partitionBy("source", "b").orderBy("h", "doc_id", "text_crc32", "size")
    placed = (
        rows.join(offsets, ["source", "b"])
        .withColumn("rank", F.coalesce("before", F.lit(0)) + F.row_number().over(in_bucket) - 1)
        .withColumn("fraction", (F.col("rank") + shift) / F.col("n_source"))
        .withColumn("f", F.floor(F.col("fraction") * buckets).cast("int"))
        .select("doc_id", "source", "size", "text_crc32", "rank", "fraction", "f")
    )

    everything = Window.orderBy("f")
    starts = (
        placed.groupBy("f")
        .agg(F.count("*").alias("n"))
        .select(
            "f",
            F.sum("n").over(everything.rowsBetween(Window.unboundedPreceding, -1)).alias("start"),
            F.sum("n")
            .over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias("total"),
        )
    )
    in_range = Window.partitionBy("f").orderBy("fraction", "source", "rank")
    return (
        placed.join(starts, "f")
        .withColumn("place", F.coalesce("start", F.lit(0)) + F.row_number().over(in_range) - 1)
        .withColumn("shard", F.expr(f"(place * {shards}) div total"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.col("shard").cast("int").alias("shard"),
            F.expr(f"place - (shard * total + {shards - 1}) div {shards}").alias("slot"),
        )
    )
