"""Connected components of a table of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import written


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _links_to_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b): root is the least node it reaches.

    Each round links all larger neighbours of a node to its least neighbour, then all smaller ones.
    Both steps are a minimum, combined before the shuffle, and a join whose large keys Spark can
    split: a node with a third of all links is no task of its own. The number of rounds grows with
    the logarithm of the longest chain. Rounds are written tables. Null ends and loops are ignored.
    """
    both = links.select("a", "b").filter("a <> b")
    edges = written(
        both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _digest(edges)
    while before[0]:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        # larger neighbours; (a, m) pairs of the nodes themselves come with the neighbours' rows
        edges = written(_links_to_least(around.filter("b > a"), least).distinct())
        least = written(edges.groupBy("a").agg(F.min("b").alias("m")))
        edges = written(
            _links_to_least(edges, least)
            .unionByName(least.select("a", F.col("m").alias("b")))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
