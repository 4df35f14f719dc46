"""Small tables with everything that real ones have."""

from __future__ import annotations

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
CLASHES = (
    "a b uid row fp h p key data maybe _maybe _key _a _b _drop n_lines n_dropped score accepted lang_pred drop "
    "contaminated item_ids n_windows least_edits length piece start ids sequence_id offset block shard slot size "
    "text_crc32 rank fraction f n least root component_id host path rule verdict token url_ doc leaf tokens line"
).split()

LONG = " ".join(f"word{i % 977} und der {i}" for i in range(12_000))

ROWS = [
    (1, "The quick brown fox\njumps over the lazy dog", "en", "s"),
    (1, "The quick brown fox\njumps over the lazy dog", "en", "s"),
    (2, "The quick brown fox\njumps over the lazy dog", None, None),
    (3, None, "en", "s"),
    (4, "", "de", None),
    (None, "  \n\t ", None, "s"),
    (None, None, None, None),
    (5, "12 345 !!", "fr", "t"),
    (6, LONG, "de", "t"),
    (7, LONG + " and more", "de", "t"),
]


def edge_documents(spark):
    """Null and empty values, repeated rows, a long text, and columns named like the operators' own."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text").cast("long")).select(
        "*", *[F.lit("clash").alias(c) for c in CLASHES]
    )


def documents(spark, rows):
    return spark.createDataFrame(list(rows), "doc_id long, text string")


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
