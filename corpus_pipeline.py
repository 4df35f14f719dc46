"""A corpus pipeline of five operators: raw documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanstrata.llm.common import importable, without, written
from loanstrata.llm.decontamination import find_leaks
from loanstrata.llm.language_id import classify, fit
from loanstrata.llm.line_dedup import drop_recurring_lines
from loanstrata.llm.queries import packed_documents
from loanstrata.llm.simhash import near_duplicates

#: The columns of documents, which every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_CARRIED = COLUMNS[1:]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the languages from the labels of its input and drops the documents it rejects: texts
    that are null or have no letter, and those whose score is under the calibrated least one."""
    return classify(docs, fit(docs), carry=_CARRIED).filter("accepted").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of recurring templates from the texts, and counts the characters of these anew.

    Every document stays, also one without lines left: its text is empty then. Null texts stay null, equal
    texts lose the same lines, and a null id comes after all others where the first text keeps its line."""
    changed = F.col("n_dropped") > 0
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return drop_recurring_lines(docs.select(*COLUMNS)).withColumn("n_chars", n_chars).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that fingerprints link, the one of the least doc_id stays; of rows
    with equal ids the first. A null id comes before all others."""
    # written, so that a number names the same row in every job, however a scan is cut
    numbered = written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))
    named = numbered.select(F.struct("doc_id", "row").alias("id"), "text")
    found = near_duplicates(named, words=4, distance=4, id_col="id")
    dropped = found.filter("doc_id.row <> component_id.row").select(F.col("doc_id.row").alias("row"))
    return without(numbered, dropped, "row").select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark.

    Null and empty texts, and all of them if the benchmark is empty, hold none; rows of equal or null ids
    are documents of their own."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(docs, benchmark, carry=_CARRIED).filter(~F.col("contaminated")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences.

    A null or empty text is the piece of its end token; rows of equal or null ids are documents of their
    own; no document gives no row."""
    return packed_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Language ID, near-dedup, decontamination and packing aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
