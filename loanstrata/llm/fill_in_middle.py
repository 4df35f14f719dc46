"""Fill-in-middle texts: lines regrouped as prefix, middle and suffix, whole batches at a time by pyarrow.compute."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import rows

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")

_TEXT = pa.large_string()


def fill_in_middle(
    docs: DataFrame,
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    marks: tuple[str, str, str] = MARKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every text with its lines regrouped: (doc_id, n, form, prefix_chars, middle_chars, output).

    A text of n lines is cut at two of its n + 1 line borders. Four numbers of the id's hash choose the
    cuts, whether the text is regrouped (``rate`` of 100) and whether the suffix comes first (``spm`` of
    100, form ``spm``; else ``psm``). An empty text, one that holds a mark, and one that isn't regrouped
    keep form ``plain`` and are their own output; prefix_chars and middle_chars are null there.

    One row in, one row out, no shuffle: a task holds some megabytes of text, or one text if that is
    longer. A null text is an empty one; a null id is hashed as an empty one. Rows of equal ids are cut
    by the same numbers. Other columns are left out.
    """
    if any(not re.fullmatch(r"<[^<>]+>", m) for m in marks) or len(set(marks)) < 3:
        raise ValueError("marks are three different strings in angle brackets")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def regroup(batches):
        for batch in batches:
            for part in rows([batch], "text"):
                yield _regroup(part, rate, spm, marks)

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    return docs.select(F.col(id_col).alias("doc_id"), text, *numbers).mapInArrow(regroup, schema)


def _regroup(batch: pa.RecordBatch, rate: int, spm: int, marks: tuple[str, str, str]) -> pa.RecordBatch:
    text = batch.column("text").cast(_TEXT)
    h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4))

    # units: all lines of the batch in one array, each with the row it belongs to and its place there
    lists = pc.split_pattern(text, "\n")
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    starts = lists.offsets.to_numpy()
    ordinal = np.arange(len(flat)) - starts[parent]
    last = ordinal == (starts[1:] - starts[:-1] - 1)[parent]
    units = _join(flat, pc.if_else(pa.array(last), pa.scalar("", _TEXT), pa.scalar("\n", _TEXT)))
    # what follows the last line break is a unit only if it isn't empty
    ends_open = pc.binary_length(flat).to_numpy() > 0
    n = starts[1:] - starts[:-1] - 1 + ends_open[starts[1:] - 1]

    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    prefix, middle, suffix = (_gather(units, parent, role == r, batch.num_rows) for r in range(3))

    p, s, m = marks
    plain = pc.or_(pc.equal(pc.binary_length(text), 0), pa.array(h3 % 100 >= rate))
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(text, mark))
    suffix_first = pa.array(h4 % 100 < spm)
    regrouped = pc.if_else(suffix_first, _join(s, suffix, p, prefix, m, middle), _join(p, prefix, s, suffix, m, middle))
    form = pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm"))
    no_chars = pa.scalar(None, pa.int64())
    columns = {
        "doc_id": batch.column("doc_id"),
        "n": pa.array(n.astype(np.int64)),
        "form": form,
        "prefix_chars": pc.if_else(plain, no_chars, pc.utf8_length(prefix).cast(pa.int64())),
        "middle_chars": pc.if_else(plain, no_chars, pc.utf8_length(middle).cast(pa.int64())),
        "output": pc.if_else(plain, text, regrouped).cast(pa.string()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _gather(units: pa.Array, parent: np.ndarray, chosen: np.ndarray, n_rows: int) -> pa.Array:
    """The chosen units of each row as one text; empty where a row has none."""
    ends = np.cumsum(np.bincount(parent[chosen], minlength=n_rows))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), units.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar("", _TEXT))


def _join(*parts: pa.Array | str) -> pa.Array:
    parts = [pa.scalar(x, _TEXT) if isinstance(x, str) else x for x in parts]
    return pc.binary_join_element_wise(*parts, pa.scalar("", _TEXT))


def restored(made: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The rows of `fill_in_middle` with a column ``restored``: the text, read from output and form alone."""

    def rebuild(batches):
        for batch in batches:
            for part in rows([batch], "output"):
                yield part.append_column("restored", _rebuild(part, marks).cast(pa.string()))

    return made.mapInArrow(rebuild, made.schema.simpleString()[7:-1] + ",restored:string")


def _rebuild(batch: pa.RecordBatch, marks: tuple[str, str, str]) -> pa.Array:
    p, s, m = marks
    form, output = batch.column("form"), batch.column("output").cast(_TEXT)
    found, places = [], []
    for name, first, second in (("plain", "", ""), ("psm", p, s), ("spm", s, p)):
        at = np.flatnonzero(pc.equal(form, name).to_numpy(zero_copy_only=False))
        text = output.take(pa.array(at))
        if first:
            # first mark, one part, second mark, another part, mark of the middle, middle
            one, rest = _around(text, second)
            other, middle = _around(rest, m)
            one = pc.utf8_slice_codeunits(one, len(first))
            prefix, suffix = (one, other) if name == "psm" else (other, one)
            text = _join(prefix, middle, suffix)
        found.append(text)
        places.append(at)
    order = np.argsort(np.concatenate(places), kind="stable")
    return pa.concat_arrays(found).take(pa.array(order))


def _around(text: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the first ``mark`` of each text, which has one."""
    parts = pc.split_pattern(text, mark, max_splits=1)
    return pc.list_element(parts, 0), pc.list_element(parts, 1)
