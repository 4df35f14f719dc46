"""Line dedup by a log-template tree: lines whose template recurs across documents are dropped."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import Sieve, maybe_in, rows, text_key, written

_DIGIT = re.compile(rb"[0-9]")
_ANY = b"<*>"


def _tokens(line: bytes) -> list[bytes]:
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [_ANY if _DIGIT.search(t) else t for t in tokens]
    return tokens


def _leaf(tokens: list[bytes], depth: int) -> int:
    """Node of the tree: number of tokens, then the leading tokens."""
    return _signed(xxhash.xxh64_intdigest(b" ".join([b"%d" % len(tokens), *tokens[:depth]])))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _exact(line: bytes, least: int) -> int | None:
    """A hash of the line's tokens as they stand, if there are enough."""
    tokens = line.split()
    return _signed(xxhash.xxh64_intdigest(b" ".join(tokens), 2)) if len(tokens) >= least else None


def _leaves(depth: int, long: int):
    """Per text the leaves that its lines reach, and the hashes of its long lines (``exact``)."""

    def run(batches):
        for part in rows(batches, "text"):
            a, b, h, exact = [], [], [], []
            for x, y, text in zip(*(part.column(c).to_pylist() for c in ("a", "b", "text")), strict=True):
                lines = (text or "").encode().split(b"\n")
                found = {_leaf(t, depth) for line in lines if (t := _tokens(line))}
                whole = {e for line in lines if (e := _exact(line, long)) is not None}
                h += [*found, *whole]
                exact += [False] * len(found) + [True] * len(whole)
                a += [x] * (len(found) + len(whole))
                b += [y] * (len(found) + len(whole))
            columns = [pa.array(c, pa.int64()) for c in (a, b, h)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(exact, pa.bool_())], ["a", "b", "h", "exact"])

    return run


def _lines(depth: int, long: int, leaves: Sieve, twice: Sieve):
    """Lines that may recur: ``leaf``, ``p`` and ``tokens`` are null where the leaf isn't frequent, ``x`` and ``y``
    where the line as it stands comes in one text only."""

    def run(batches):
        names = ["doc_id", "a", "b", "line", "leaf", "p", "tokens", "x", "y"]
        for part in rows(batches, "text"):
            out = [[] for _ in names]
            doc = part.column("doc_id")
            for i, (u, v, text) in enumerate(zip(*(part.column(c).to_pylist() for c in ("a", "b", "text")), strict=True)):
                lines = (text or "").encode().split(b"\n")
                found = [(k, line, t, _leaf(t, depth), _exact(line, long)) for k, line in enumerate(lines) if (t := _tokens(line))]
                passed = leaves.passes(np.array([f[3] for f in found], np.int64)).tolist()
                again = twice.passes(np.array([f[4] or 0 for f in found], np.int64)).tolist()
                for (k, line, tokens, leaf, x), frequent, more in zip(found, passed, again, strict=True):
                    row = [i, u, v, k, None, None, None, None, None]
                    if frequent:
                        rest = [_signed(xxhash.xxh64_intdigest(t)) for t in tokens[depth:]]
                        row[4:7] = leaf, _signed(xxhash.xxh64_intdigest(b" ".join(tokens), 1)), rest
                    if more and x is not None:
                        row[7:] = x, _signed(xxhash.xxh64_intdigest(b" ".join(line.split()), 3))
                    if frequent or row[7] is not None:
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    doc.take(pa.array(out[0], pa.int64())),
                    *(pa.array(c, t) for c, t in zip(out[1:], _TYPES, strict=True)),
                ],
                names,
            )

    return run


_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]


def _after_the_first(lines: DataFrame, group: list[str], least: int) -> DataFrame:
    """(a, b, line) of the groups that at least ``least`` distinct texts have, but for the text of least id."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "a", "b")
    recurring = (
        lines.groupBy(*group, "a", "b").agg(F.min("doc_id").alias("doc_id"))
        .groupBy(*group).agg(F.count("*").alias("n"), F.min(first).alias("first"))
        .filter(F.col("n") >= least)
        .select(*group, F.col("first.a").alias("a1"), F.col("first.b").alias("b1"))
    )
    later = (F.col("a") != F.col("a1")) | (F.col("b") != F.col("b1"))
    return lines.join(written(recurring), group).filter(later).select("a", "b", "line")


def dropped_lines(
    docs: DataFrame, depth: int, recur: int, similarity: float, long: int, id_col: str, text_col: str
) -> DataFrame:
    """(a, b, drop): per distinct text, by its key, the numbers of the lines to drop."""
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), text_key(text_col).alias("key"), F.col(text_col).alias("text")
    ).select("doc_id", "key.a", "key.b", "text")
    doc_type = docs.schema[id_col].dataType.simpleString()

    # 1. Leaves of the tree that enough distinct texts reach, and long lines that two have as they stand;
    #    all others hold nothing that recurs.
    found = keyed.select("a", "b", "text").mapInArrow(_leaves(depth, long), "a long, b long, h long, exact boolean")
    counted = written(
        found.distinct().groupBy("h", "exact").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= F.when(F.col("exact"), 2).otherwise(recur)).select("h", "exact")
    )
    frequent = counted.filter("not exact").select(F.col("h").alias("leaf"))
    # 2. These lines, one row per distinct text.
    lines = written(
        keyed.mapInArrow(
            _lines(depth, long, Sieve(frequent, "leaf"), Sieve(counted.filter("exact"), "h")),
            f"doc_id {doc_type}, a long, b long, line int, leaf long, p long, tokens array<long>, x long, y long",
        )
        .groupBy("a", "b", "line", "leaf", "p", "x", "y")
        .agg(F.min("doc_id").alias("doc_id"), F.any_value("tokens").alias("tokens"))
    )
    verbatim = lines.filter("x IS NOT NULL").select("doc_id", "a", "b", "line", "x", "y")
    lines = lines.filter("leaf IS NOT NULL").drop("x", "y").join(frequent, "leaf", "left_semi")
    # 3. Within a leaf, a token that few lines have at its place is a variable field.
    patterns = written(
        lines.groupBy("leaf", "p", "a", "b").agg(F.any_value("tokens").alias("tokens"))
        .groupBy("leaf", "p").agg(F.any_value("tokens").alias("tokens"), F.count("*").alias("n"))
    )
    at = patterns.select("leaf", "p", "n", F.posexplode("tokens").alias("place", "token"))
    constant = written(
        at.groupBy("leaf", "place", "token").agg(F.sum("n").alias("n")).filter(F.col("n") >= recur).drop("n")
    )
    fixed = at.join(constant, ["leaf", "place", "token"]).groupBy("leaf", "p").agg(
        F.count("*").alias("fixed"), F.bit_xor(F.xxhash64("place", "token")).alias("template")
    )
    n_tokens = F.size("tokens") + depth  # a line of fewer tokens is all leading ones
    templates = written(
        patterns.join(fixed, ["leaf", "p"], "left")
        .filter(F.coalesce("fixed", F.lit(0)) + depth >= similarity * n_tokens)
        .select("leaf", "p", F.coalesce("template", F.lit(0)).alias("template"))
    )
    # 4. Lines of templates that recur, and long lines that do, after the first text that has them.
    carried = written(lines.drop("tokens").join(templates, ["leaf", "p"]))
    dropped = _after_the_first(carried, ["leaf", "template"], recur).unionAll(_after_the_first(verbatim, ["x", "y"], 2))
    return dropped.groupBy("a", "b").agg(F.collect_set("line").alias("drop"))


def drop_recurring_lines(
    docs: DataFrame,
    depth: int = 3,
    recur: int = 10,
    similarity: float = 0.7,
    long: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of the text; adds n_lines, n_dropped.

    A line is a list of tokens between ASCII white space. Tokens with a digit are variable fields. The
    tree has a fixed depth: a line goes to the leaf of its number of tokens and its first ``depth``
    tokens. In a leaf, a later token is kept in the template if at least ``recur`` lines (one per
    distinct line and text) have it at that place; the others become variable fields. A line follows
    its template if at least the share ``similarity`` of its tokens is fixed. A template recurs if
    lines of at least ``recur`` distinct texts follow it; equal texts count once. A line of at least ``long``
    tokens recurs as soon as two distinct texts have it as it stands, white space aside.

    Every line of a recurring template, and every recurring long line, is dropped, but for the first text
    (least id, then key) that carries it: that one keeps it, so that no content vanishes from the
    corpus. All copies of a text are treated alike. Lines without a token stay. A null text stays null with 0 lines; a null id
    comes last. Repeated rows are kept. Extra columns pass through, but for the two that are added.

    Counts are combined before each shuffle and joins are on written tables, whose large keys Spark
    splits: a line that a third of the documents has is one pattern. Which leaves and lines are worth a
    second look is told by bitmaps (`Sieve`).
    """
    drops = written(dropped_lines(docs, depth, recur, similarity, long, id_col, text_col))
    # the row in a struct, so that no column of its own can clash
    keyed = docs.select(text_key(text_col).alias("key"), F.struct(*docs.columns).alias("doc"))
    some, others = maybe_in(keyed.select("key.a", "key.b", "doc"), drops, ["a", "b"])
    out = some.join(drops, ["a", "b"], "left").select("doc", "drop").unionByName(
        others.select("doc", F.lit(None).cast("array<int>").alias("drop"))
    )
    text = F.col("doc").getField(text_col)
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("drop", i)), "\n")
    return out.select(
        *[
            (F.when(F.col("drop").isNull(), text).otherwise(kept) if c == text_col else F.col("doc").getField(c)).alias(c)
            for c in docs.columns
            if c not in ("n_lines", "n_dropped")
        ],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).alias("n_dropped"),
    )
