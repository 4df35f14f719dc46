"""One query per operator over the whole of its table, with production parameters."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanstrata.llm.ann import nearest
from loanstrata.llm.best_fit_packing import pack
from loanstrata.llm.centroid_clustering import cluster
from loanstrata.llm.chat_formatting import conversation_log, format_conversations, read_back
from loanstrata.llm.common import importable, scratch, written
from loanstrata.llm.decontamination import find_leaks
from loanstrata.llm.fill_in_middle import fill_in_middle, restored
from loanstrata.llm.language_id import classify, fit, held_out
from loanstrata.llm.line_dedup import drop_recurring_lines
from loanstrata.llm.sharding import shard
from loanstrata.llm.simhash import near_duplicates
from loanstrata.llm.suffix_dedup import kept_digests
from loanstrata.llm.token_output import pack_tokens, write_matrices
from loanstrata.llm.tokens import pieces
from loanstrata.llm.url_filters import filter_urls, rule_table

URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

#: Tokens of a packed sequence.
SEQUENCE = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return classify(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs, depth=3, recur=10, similarity=0.7, long=8)


def vocabulary() -> str:
    """The vocabulary file of the packing operators; ``LOANSTRATA_VOCABULARY`` names another."""
    if path := os.environ.get("LOANSTRATA_VOCABULARY"):
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed matrices as files, read again."""
    packed = pack_tokens(_table(spark, sf_dir, "documents"), vocabulary(), SEQUENCE, end_id=0)
    folder = f"{scratch(spark)}/matrices/{uuid.uuid4().hex}"
    write_matrices(packed, folder)
    return spark.read.schema(packed.schema).parquet(folder)


def packed_documents(docs: DataFrame) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    cut = written(pieces(docs, vocabulary(), SEQUENCE, end_id=0).drop("ids"))
    return pack(cut, SEQUENCE).drop("uid")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), words=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digests(_table(spark, sf_dir, "documents"), length=400, words=51)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of shards differ by at most one; the number of shards moves rows between old ones."""
    return shard(_table(spark, sf_dir, "documents"), shards=40, spread=True).select(
        "*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


#: Both turns of conversation -7: a text with the control strings of a template.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    both = conversations.unionByName(spark.createDataFrame(added, "conv_id long, turn long, role string, text string"))
    return read_back(format_conversations(conversation_log(both)))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restored(fill_in_middle(_table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2, dims=64, scale=256)


LLM_QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_output": op5_token_output,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_ann_search": op7_ann_search,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_sharding": op10_sharding,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_centroid_clustering": op13_centroid_clustering,
}
