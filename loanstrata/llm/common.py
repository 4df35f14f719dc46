"""What the operators share: the shared scratch folder, written tables, text slices."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Without that setting a local session gets a folder of its own; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="loanstrata-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Workers don't share the driver's ``sys.path``. Where executors have no such folder, install the
    package there or send it along (``--py-files``); the entry does no harm then.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


@contextmanager
def small_batches(spark: SparkSession, most: int = 4_000_000) -> Iterator[None]:
    """In here Spark hands batches of some ``most`` bytes to Python, or one row if that is larger."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and not lost with an executor."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(column: str = "text"):
    """128 bits that stand for a text: equal texts are handled once."""
    text = F.coalesce(F.col(column), F.lit(""))
    return F.struct(
        F.xxhash64(text).alias("a"),
        F.xxhash64(F.lit("second half"), text, F.length(text)).alias("b"),
    )


def rows(batches: Iterator[pa.RecordBatch], by: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``most`` bytes in column ``by``; one row is never cut.

    Bounds what a task holds at a time, however many rows Spark puts into a batch.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(by)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size + 16
        if start < batch.num_rows:
            yield batch.slice(start)


class Sieve:
    """A bitmap over 64-bit hashes: says no only where the table has no such hash.

    It has 32 bits or more for each hash, as the written table counts them, but 2 ** ``most`` at the
    most (32 MB): that is all that reaches the driver and the tasks. A fuller one lets more through;
    whoever uses it checks exactly afterwards.
    """

    def __init__(self, hashes: DataFrame, column: str, most: int = 28) -> None:
        self.bits = bits = min(most, max(16, (32 * hashes.count()).bit_length()))
        h = F.col(column)
        places = F.array(*[F.shiftrightunsigned(h, s).bitwiseAND(F.lit((1 << bits) - 1)) for s in (0, bits)])
        words = (
            hashes.select(F.explode(places).alias("at"))
            .groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("value"))
            .toArrow()
        )
        self.words = np.zeros(1 << (bits - 6), np.int64)
        self.words[words.column("word").to_numpy()] = words.column("value").to_numpy()

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for s in (0, self.bits):
            at = (hashes >> s) & ((1 << self.bits) - 1)
            out &= (self.words[at >> 6] >> (at & 63)) & 1 == 1
        return out


def maybe_in(df: DataFrame, table: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose key may be in ``table``, and rows whose key surely isn't.

    ``key`` has no nulls. Only the first part needs a join; the other isn't shuffled for it.
    """
    h = F.xxhash64(*key)
    sieve = Sieve(table.select(h.alias("h")), "h")

    @F.pandas_udf("boolean")
    def passes(hashes: pd.Series) -> pd.Series:
        return pd.Series(sieve.passes(hashes.to_numpy()))

    # the row in a struct, so that no column of its own can clash
    marked = df.select(F.struct(*df.columns).alias("row"), passes(h).alias("maybe"))
    return marked.filter("maybe").select("row.*"), marked.filter(~F.col("maybe")).select("row.*")


def without(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key isn't in ``table``."""
    table = written(table.select(key).distinct())
    some, others = maybe_in(df, table, [key])
    return others.unionByName(some.join(table, key, "left_anti"))
