"""Distinct customers of stores, over any of their snapshots, from exact bitmaps that are kept per snapshot.

Every customer has a number, kept in ``analysis/customer_ids``. The bitmaps of a store hold which numbers
each snapshot has: blocks of 32768 bits, which an OR merges. So a new month is read once, and the customers
of any set of months are counted on the blocks, without the rows of the store and without a hash of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanstrata.schemas import CUSTOMER, SNAPSHOT
from loanstrata.sources.lake import Lake

STORES = ("label_store", "feature_store")
_IDS = ("analysis", "customer_ids")
#: Rows without a customer count as one customer: the number that no customer has.
_NOBODY = 0
#: Days from year 1 to 1970, so that no date has a negative number.
_FIRST_DAY = 719_163


def _table(store: str) -> str:
    return f"{store}_customers"


def number_customers(
    lake: Lake, rows: DataFrame, snapshots: Sequence[date], buckets: int = 0, ranges: int = 1024
) -> None:
    """Give a number to each customer of ``rows``, rows of these snapshots, that has none yet.

    A number is the customer's first snapshot here and a rank within it, so the numbers of a snapshot
    are dense and few blocks of a bitmap hold them. Ranks come from counts of ``ranges`` hash ranges and
    places within a range; no snapshot is sorted whole. Numbers never change. Two calls at the same time
    could number the same customer: of these the later one fails, and changes nothing.
    """
    manifest = lake.manifest(*_IDS)
    given = lake.rows(*_IDS)
    new = rows.where(F.col(CUSTOMER).isNotNull()).groupBy(CUSTOMER).agg(F.min(SNAPSHOT).alias(SNAPSHOT))
    with lake.by_customer(*_IDS) as known:
        if known is not None:
            new = new.join(known.select(CUSTOMER), CUSTOMER, "left_anti")
        new = new.withColumn("range", F.pmod(F.xxhash64(CUSTOMER), F.lit(ranges)))
        before = Window.partitionBy(SNAPSHOT).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        counted = new.groupBy(SNAPSHOT, "range").agg(F.count("*").alias("n"))
        start = counted.select(SNAPSHOT, "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        # one row per snapshot: the numbers that earlier calls gave in it
        taken = lake.spark.createDataFrame(
            [(s, given.get(s, 0)) for s in snapshots], f"{SNAPSHOT} date, taken bigint"
        )
        place = F.row_number().over(Window.partitionBy(SNAPSHOT, "range").orderBy(CUSTOMER))
        rank = F.col("taken") + F.col("start") + F.col("place")
        day = (F.unix_date(SNAPSHOT) + _FIRST_DAY).cast("bigint")
        numbered = (
            new.withColumn("place", place)
            .join(start, [SNAPSHOT, "range"])
            .join(F.broadcast(taken), SNAPSHOT)
            .select(CUSTOMER, (F.shiftleft(day, 32) + rank).alias("id"), SNAPSHOT)
        )
        if known is not None:
            numbered = known.where(F.col(SNAPSHOT).isin(list(snapshots))).unionByName(numbered)
        since = manifest.version if manifest else 0
        lake.write(numbered, *_IDS, snapshots, buckets=buckets, since=since)


def bitmaps(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The numbers of the customers in each snapshot, as blocks of a bitmap."""
    # One row of each customer and snapshot, combined before the shuffle: no customer is a hot one.
    keys = rows.select(CUSTOMER, SNAPSHOT).distinct()
    found = keys.join(ids.select(CUSTOMER, "id"), CUSTOMER, "left")
    number = F.coalesce("id", F.lit(_NOBODY).cast("bigint"))
    bits = found.select(
        SNAPSHOT, F.bitmap_bucket_number(number).alias("block"), F.bitmap_bit_position(number).alias("bit")
    )
    # A block has 4 kB however few bits are set, and a map task has a few bits of every block: the bits
    # are shuffled, and blocks made where they are complete.
    dealt = bits.repartition(SNAPSHOT, "block")
    return dealt.groupBy(SNAPSHOT, "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def refresh_customers(lake: Lake, store: str, buckets: int = 0) -> list[date]:
    """Make the bitmaps of the snapshots of a gold table that changed since they were made; returns these."""
    runs, made = lake.runs("gold", store), lake.made_from("analysis", _table(store))
    changed = [date.fromisoformat(k) for k in sorted(runs.keys() | made.keys()) if runs.get(k) != made.get(k)]
    if changed:
        rows = lake.read("gold", store, changed)
        number_customers(lake, rows, changed, buckets)
        with lake.by_customer(*_IDS) as ids:
            blocks = bitmaps(rows, ids)
            lake.write(blocks, "analysis", _table(store), changed, measured=lambda _: {"made_from": runs})
    return changed


def distinct_customers(blocks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of distinct customers in all these blocks together, for each value of ``by``."""
    merged = blocks.groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n_customers")
    return merged.groupBy(*by).agg(counted)


def counted_summary(lake: Lake, snapshots: Sequence[date] | None = None) -> DataFrame:
    """Rows and distinct customers of each store in these snapshots, by default in all.

    As `quality.store_summary`, but no row of a store is read: rows come from the manifest, customers
    from the bitmaps, which `refresh_customers` must have brought up to date.
    """
    rows, blocks = [], []
    for store in STORES:
        if lake.runs("gold", store) != lake.made_from("analysis", _table(store)):
            raise ValueError(f"the bitmaps of {store} are out of date: call refresh_customers first")
        n = sum(n for day, n in lake.rows("gold", store).items() if snapshots is None or day in snapshots)
        if n:
            rows.append((store, n))
            blocks.append(lake.read("analysis", _table(store), snapshots).withColumn("store", F.lit(store)))
    if not rows:
        return lake.spark.createDataFrame([], "store string, n_rows bigint, n_customers bigint")
    n_rows = lake.spark.createDataFrame(rows, "store string, n_rows bigint")
    # one row per store
    return n_rows.join(distinct_customers(reduce(DataFrame.unionByName, blocks), ["store"]), "store")
