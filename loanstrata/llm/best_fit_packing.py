"""Best-fit packing by a grouping genetic algorithm on islands with elite migration."""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanstrata.llm.common import written

_STATE = "block long, island int, lengths binary, genomes binary, immigrant binary, bins int"


def _best_fit(lengths: np.ndarray, items: np.ndarray, genome: np.ndarray, bins: int, capacity: int) -> int:
    """Place ``items``, longest first, each into the fullest bin that takes it; number of bins after."""
    placed = genome[genome >= 0]
    free = capacity - np.bincount(placed, weights=lengths[genome >= 0], minlength=bins).astype(int)
    room = sorted((f, b) for b, f in enumerate(free.tolist()) if f > 0)
    for i in items[np.argsort(-lengths[items], kind="stable")].tolist():
        size = int(lengths[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b, bins = capacity, bins, bins + 1
        genome[i] = b
        if left > size:
            insort(room, (left - size, b))
    return bins


def _exchange(lengths: np.ndarray, displaced: np.ndarray, genome: np.ndarray, bins: int, capacity: int) -> np.ndarray:
    """Trade one or two documents of a bin for a longer displaced one where the bin gets fuller by it:
    what is left over is shorter and easier to place. Returns the documents displaced now."""
    if not bins or not len(displaced):
        return displaced
    size = lengths.tolist()
    out = sorted((size[i], i) for i in displaced.tolist())
    members: list[list[int]] = [[] for _ in range(bins)]
    for i in np.flatnonzero(genome >= 0).tolist():
        members[genome[i]].append(i)
    for b, own in enumerate(members):
        slack = capacity - sum(size[i] for i in own)
        while slack > 0:
            best = None
            for k, i in enumerate(own):
                # this one, or this one and another, for a longer one that is displaced
                for leave in ([i], *([i, j] for j in own[:k])):
                    now = sum(size[x] for x in leave)
                    at = bisect_left(out, (now + slack + 1, -1)) - 1
                    if at >= 0 and out[at][0] > now and (best is None or out[at][0] - now > best[0]):
                        best = (out[at][0] - now, leave, at)
            if best is None:
                break
            gain, leave, at = best
            _, i = out.pop(at)
            genome[i] = b
            own.append(i)
            for i in leave:
                genome[i] = -1
                own.remove(i)
                insort(out, (size[i], i))
            slack -= gain
    return np.array([i for _, i in out], np.int64)


def _renumbered(genome: np.ndarray) -> np.ndarray:
    return np.unique(genome, return_inverse=True)[1].astype(np.int32)


def _fitness(lengths: np.ndarray, genome: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    fill = np.bincount(genome, weights=lengths) / capacity
    return (-fill.size, float((fill * fill).mean()))


def _offspring(lengths, mother, father, capacity, rng) -> np.ndarray:
    """The father's well-filled bins go whole into the mother; she gives up the bins they touch."""
    fill = np.bincount(father, weights=lengths)
    order = np.argsort(-(fill + rng.random(fill.size) * capacity * 0.02), kind="stable")
    donors = np.zeros(fill.size, bool)
    donors[order[: max(1, int(fill.size * rng.uniform(0.2, 0.6)))]] = True
    injected = donors[father]
    hit = np.zeros(int(mother.max()) + 1, bool)
    hit[mother[injected]] = True
    # Mutation: the emptiest bins that are left are dissolved too.
    left = np.flatnonzero(~hit)
    if left.size:
        weight = np.bincount(mother, weights=lengths, minlength=hit.size)[left]
        hit[left[np.argsort(weight, kind="stable")[: 1 + left.size // 20]]] = True
    child = np.where(injected, father + hit.size, np.where(hit[mother], -1, mother)).astype(np.int64)
    displaced = np.flatnonzero(child < 0)
    stay = child >= 0
    child[stay] = np.unique(child[stay], return_inverse=True)[1]
    bins = int(child.max()) + 1 if stay.any() else 0
    displaced = _exchange(lengths, displaced, child, bins, capacity)
    _best_fit(lengths, displaced, child, bins, capacity)
    return _renumbered(child)


def _founder(lengths: np.ndarray, capacity: int, rng, spread: float) -> np.ndarray:
    """Best fit, longest first, after lengths are blurred by ``spread``: 0 is the plain rule."""
    genome = np.full(lengths.size, -1, np.int64)
    if not spread:
        _best_fit(lengths, np.arange(lengths.size), genome, 0, capacity)
        return _renumbered(genome)
    order = np.argsort(-(lengths * rng.uniform(1 - spread, 1 + spread, lengths.size)), kind="stable")
    bins = 0
    for part in np.array_split(order, max(1, lengths.size // 64)):
        bins = _best_fit(lengths, part, genome, bins, capacity)
    return _renumbered(genome)


def _evolve(lengths, genomes, capacity, generations, rng) -> list[np.ndarray]:
    """Tournaments for parents; the child takes the place of the worst if it is better."""
    least = -(-int(lengths.sum()) // capacity)
    ranked = sorted(((_fitness(lengths, g, capacity), i, g) for i, g in enumerate(genomes)), key=lambda x: x[:2])
    for step in range(generations):
        if -ranked[-1][0][0] <= least:
            break
        mother, father = (ranked[max(rng.integers(len(ranked), size=2))][2] for _ in range(2))
        child = _offspring(lengths, mother, father, capacity, rng)
        fit = _fitness(lengths, child, capacity)
        if fit > ranked[0][0]:
            ranked[0] = (fit, len(genomes) + step, child)
            ranked.sort(key=lambda x: x[:2])
    return [g for _, _, g in reversed(ranked)]


def pack(
    items: DataFrame,
    capacity: int,
    block: int = 4096,
    islands: int = 2,
    population: int = 4,
    epochs: int = 2,
    generations: int = 8,
    seed: int = 0,
    rounds: int = 3,
    loose: float = 0.05,
) -> DataFrame:
    """Pack rows of ``length`` into as few sequences of ``capacity`` as it can: adds sequence_id, offset.

    ``items`` is a written table with the columns uid, told apart by it, and length (1 to
    ``capacity``). Full pieces are sequences of their own. The others are dealt by a hash of uid into
    blocks of about ``block`` rows, so that lengths, sources and copies mix and every block is a
    bounded task. Then the emptiest bins of all blocks, the share ``loose`` of each, are dealt anew and
    packed once more, up to ``rounds`` times in all, as long as that saves a sequence. No bound on the waste
    is promised: all of sf0.1 takes as many sequences as best fit over the whole table, 400 exact
    triples up to three more than 400.

    Every block is solved on ``islands``. An island breeds ``population`` assignments: crossover
    injects the father's well-filled bins whole, dissolves the mother's bins that hold the same
    documents, and best-fits what is displaced. After each epoch the elite of an island goes to the
    next one as an immigrant. Islands are rows of a small table, lengths and assignments only. An
    island stops at the lower bound. The best island of a block numbers its sequences.

    Offsets are gapless from 0. Rows of equal columns are items of their own, if their uid differs; other
    columns may be null. An empty table gives an empty one.
    """
    budget = (block, islands, population, epochs, generations)
    blocks, placed = _in_blocks(items.filter(F.col("length") < capacity), capacity, budget, seed, loose, 0)
    for number in range(1, rounds):
        if blocks == 1:
            break
        open_bins = placed.filter("loose")
        blocks, again = _in_blocks(open_bins.select(*items.columns), capacity, budget, seed + number, loose, number)
        before, after = (df.select("sequence_id").distinct().count() for df in (open_bins, again))
        if after >= before:
            break
        placed = placed.filter(~F.col("loose")).unionByName(again)
    full = items.filter(F.col("length") >= capacity).select(
        "*",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return placed.drop("loose").unionByName(full)


def _in_blocks(
    partial: DataFrame, capacity: int, budget: tuple[int, ...], seed: int, loose: float, turn: int
) -> tuple[int, DataFrame]:
    """The number of blocks, and the rows with sequence_id, offset and ``loose``, written."""
    block, islands, population, epochs, generations = budget
    fields = partial.schema.fields
    blocks = max(1, -(-partial.count() // block))
    partial = partial.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(blocks)))

    def settle(key, pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf.sort_values("uid").length.to_numpy(np.int32)
        out = [(key[0], i, lengths.tobytes(), b"", b"", 0) for i in range(islands)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _STATE.split(", ")])

    def epoch(number: int):
        def run(batches):
            for pdf in batches:
                out = []
                for r in pdf.itertuples(index=False):
                    lengths = np.frombuffer(r.lengths, np.int32)
                    rng = np.random.default_rng([seed, number, r.island, r.block])
                    if number == 0:
                        spreads = [0.0 if r.island == 0 else 0.05, *np.linspace(0.05, 0.3, population - 1)]
                        least = -(-int(lengths.sum()) // capacity)
                        genomes = []
                        for spread in spreads:
                            genomes.append(_founder(lengths, capacity, rng, float(spread)))
                            if int(genomes[-1].max()) + 1 <= least:
                                break
                    else:
                        genomes = list(np.frombuffer(r.genomes, np.int32).reshape(-1, lengths.size))
                        genomes[-1] = np.frombuffer(r.immigrant, np.int32)
                    genomes = _evolve(lengths, genomes, capacity, generations, rng)
                    out.append(
                        (r.block, r.island, r.lengths, b"".join(g.tobytes() for g in genomes), genomes[0].tobytes(),
                         int(genomes[0].max()) + 1)
                    )
                yield pd.DataFrame(out, columns=pdf.columns)

        return run

    state = partial.select("block", "uid", "length").groupBy("block").applyInPandas(settle, _STATE)
    # a number of its own: these rows are few bytes and much work, which AQE would put into one task
    tasks = min(blocks * islands, int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for number in range(epochs):
        state = written(state.repartition(tasks, "block", "island").mapInPandas(epoch(number), _STATE))
        if number + 1 < epochs:
            elites = state.select(
                "block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("immigrant").alias("elite")
            )
            state = state.join(elites, ["block", "island"]).withColumn("immigrant", F.col("elite")).drop("elite")
    best = state.groupBy("block").agg(F.min_by("immigrant", F.struct("bins", "island")).alias("genome"))

    def assign(left: pa.Table, right: pa.Table) -> pa.Table:
        # a genome numbers the bins of a block's items in the order of uid
        genome = np.empty(left.num_rows, np.int64)
        genome[np.argsort(left.column("uid").to_numpy())] = np.frombuffer(right.column("genome")[0].as_py(), np.int32)
        order = np.argsort(genome, kind="stable")
        length, bins = left.column("length").to_numpy()[order], genome[order]
        ends = np.cumsum(length)
        first = np.r_[True, bins[1:] != bins[:-1]]
        base = np.maximum.accumulate(np.where(first, ends - length, 0))
        offset = np.empty(left.num_rows, np.int64)
        offset[order] = ends - length - base
        fill = np.bincount(genome, weights=left.column("length").to_numpy())
        emptiest = np.zeros(len(fill), bool)
        emptiest[np.argsort(fill, kind="stable")[: math.ceil(loose * len(fill))]] = True
        # numbers of another round are others
        sequence = (turn << 56) + left.column("block").to_numpy() * 2**24 + genome
        placed = left.drop_columns(["block"]).append_column("sequence_id", pa.array(sequence))
        return placed.append_column("offset", pa.array(offset)).append_column("loose", pa.array(emptiest[genome]))

    added = [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    placed_schema = T.StructType([*fields, *added, T.StructField("loose", T.BooleanType())])
    placed = partial.groupBy("block").cogroup(best.groupBy("block")).applyInArrow(assign, placed_schema)
    return blocks, written(placed)
