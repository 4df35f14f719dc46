"""Token-id output: best-fit-decreasing packing by a segment tree, written as packed id matrices."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanstrata.llm.common import written
from loanstrata.llm.tokens import pieces


class CapacityTree:
    """For every free capacity the groups of bins that have it; a segment tree finds the least that fits."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.used = [0] * (2 * self.size)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _change(self, free: int, by: int) -> None:
        node = free + self.size
        while node:
            self.used[node] += by
            node >>= 1

    def put(self, free: int, first: int, bins: int) -> None:
        if bins and free:
            self.groups[free].append((first, bins))
            self._change(free, 1)

    def take(self, length: int) -> tuple[int, int, int] | None:
        """The fullest group of bins with ``length`` free: (free, first bin, bins)."""
        node = length + self.size
        if not self.used[node]:
            while node > 1 and (node & 1 or not self.used[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.used[2 * node] else 2 * node + 1
        free = node - self.size
        first, bins = self.groups[free].pop()
        self._change(free, -1)
        return free, first, bins


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, of ``counts[length]`` pieces of each length:
    runs (length, first rank, first bin, pieces per bin, offset).

    Pieces of one length are alike, so a whole group of bins with the same free capacity is filled
    at once: the work depends on the number of lengths, not of pieces. Rank r of a run goes into bin
    first + (r - first rank) // per bin, as the plain rule would do one by one.
    """
    tree, runs, bins = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            found = tree.take(length)
            if found:
                free, first, width = found
            else:
                free, first = capacity, bins
                width = -(-left // (capacity // length))
                bins += width
            per = free // length
            taken = min(left, per * width)
            runs.append((length, rank, first, per, capacity - free))
            full, rest = divmod(taken, per)
            tree.put(free - per * length, first, full)
            if rest:
                tree.put(free - rest * length, first + full, 1)
            tree.put(free, first + full + bool(rest), width - full - bool(rest))
            rank, left = rank + taken, left - taken
    return runs


def pack_tokens(
    docs: DataFrame, path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None
) -> DataFrame:
    """Packed sequences of the token ids of all documents, one row each:
    (sequence_id, length, ids, cu_seqlens, resets, doc_ids, pieces, starts).

    ``ids`` is a row of the id matrix, ``capacity`` little-endian ids of 16 bits (32 if the vocabulary
    needs them), padded with zeros. Segment k covers ``cu_seqlens[k]`` to ``cu_seqlens[k + 1]``; it is
    piece ``pieces[k]`` of document ``doc_ids[k]``, from its token ``starts[k]`` on. ``resets`` are the
    places where positions start again from 0, one per segment.

    Documents longer than ``capacity`` are cut losslessly into full pieces and one shorter one. Full
    pieces are sequences of their own. The others are packed by best fit, longest first, over the whole
    corpus: the counts of the lengths, at most ``capacity`` numbers, give the plan; a piece finds its
    place in it by its rank among pieces of its length, counted per task and summed, so that a length
    which a third of the pieces share is no task of its own.

    A null or empty text has no ids and so no row (unless ``end_id`` ends it); rows of equal ids are
    documents of their own. Other columns aren't read.
    """
    cut = written(
        pieces(docs, path, capacity, id_col, text_col, end_id, keep_ids=True).withColumn(
            "task", F.shiftright("uid", 33)
        )
    )
    partial = cut.filter(F.col("length") < capacity)
    per_task = partial.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(plan(counts, capacity), np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        # the last run of this length that starts at or before this rank
        low, high = np.searchsorted(runs[:, 0], length), np.searchsorted(runs[:, 0], length, "right")
        while (high - low > 1).any():
            middle = (low + high) // 2
            go = runs[middle, 1] <= rank
            low, high = np.where(go, middle, low), np.where(go | (high - low <= 1), high, middle)
        run = runs[low]
        behind, within = np.divmod(rank - run[:, 1], run[:, 3])
        return pd.DataFrame({"sequence_id": run[:, 2] + behind, "offset": run[:, 4] + within * length})

    of_length = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.sum("n").over(of_length).alias("before"))
    ranked = partial.select("uid", "length", "task").join(before, ["length", "task"]).select(
        "uid",
        place(
            "length",
            F.coalesce("before", F.lit(0))
            + F.row_number().over(Window.partitionBy("length", "task").orderBy("uid"))
            - 1,
        ).alias("at"),
    )
    packed = (
        partial.join(ranked, "uid")
        .select("at.sequence_id", "at.offset", "doc_id", "piece", "start", "length", "ids")
        .repartition("sequence_id")
        .sortWithinPartitions("sequence_id", "offset")
    )
    # a full piece fills a row of the matrix: it needs no shuffle
    whole = cut.filter(F.col("length") >= capacity).select(
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "doc_id",
        "piece",
        "start",
        "length",
        "ids",
    )
    doc_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        "sequence_id long, length int, ids binary, cu_seqlens array<int>, resets array<int>, "
        f"doc_ids array<{doc_type}>, pieces array<int>, starts array<long>"
    )
    return packed.mapInArrow(_matrix_rows(capacity), schema).unionByName(
        whole.mapInArrow(_matrix_rows(capacity), schema)
    )


def _matrix_rows(capacity: int):
    def run(batches):
        """Rows come sorted by sequence; the last sequence of a batch may go on in the next."""
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            ids = table.column("sequence_id").to_numpy()
            cut = int(np.flatnonzero(ids == ids[-1])[0])
            held = table.slice(cut)
            if cut:
                yield _assembled(table.slice(0, cut), capacity)
        if held is not None and held.num_rows:
            yield _assembled(held, capacity)

    return run


def _assembled(table: pa.Table, capacity: int) -> pa.RecordBatch:
    table = table.combine_chunks()
    sequence = table.column("sequence_id").to_numpy()
    length = table.column("length").to_numpy()
    firsts = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
    ends = np.r_[firsts[1:], len(sequence)]
    raw = table.column("ids").to_pylist()
    width = len(raw[0]) // max(1, int(length[0]))
    offsets = np.r_[firsts, len(sequence)].astype(np.int32)
    cu, matrix = [], []
    for a, b in zip(firsts.tolist(), ends.tolist(), strict=True):
        cu.append([0, *np.cumsum(length[a:b]).tolist()])
        matrix.append(b"".join(raw[a:b]).ljust(capacity * width, b"\0"))

    def lists(column: str) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets), table.column(column).combine_chunks())

    columns = [
        pa.array(sequence[firsts]),
        pa.array([c[-1] for c in cu], pa.int32()),
        pa.array(matrix, pa.binary()),
        pa.array(cu, pa.list_(pa.int32())),
        pa.array([c[:-1] for c in cu], pa.list_(pa.int32())),
        lists("doc_id"),
        lists("piece"),
        lists("start"),
    ]
    names = ["sequence_id", "length", "ids", "cu_seqlens", "resets", "doc_ids", "pieces", "starts"]
    return pa.RecordBatch.from_arrays(columns, names)


def write_matrices(sequences: DataFrame, folder: str, rows_per_file: int = 65_536) -> None:
    """The packed rows as Parquet files of at most ``rows_per_file`` rows of the id matrix each."""
    sequences.write.options(maxRecordsPerFile=rows_per_file, compression="zstd").parquet(folder)
