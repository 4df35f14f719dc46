"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import rows, written
from loanstrata.llm.components import components

_BITS = 64
#: Crowded values that a part may have, and how many times too many fingerprints are far too many.
_HEAVY, _FAR = 100_000, 64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, words: int) -> int:
    """Majority of the bits of the XXH64 (seed 42) of all shingles of ``words`` words; signed."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)], "<u8"
    )
    ones = np.zeros(_BITS, np.int64)
    for at in range(0, n, 65_536):
        block = hashes[at : at + 65_536]
        ones += np.unpackbits(block.view(np.uint8), bitorder="little").reshape(-1, _BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row: 64 bits, as a signed number."""
    doc_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for part in rows(batches, "text"):
            fp = [fingerprint(t, words) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {doc_type}, fp long"
    )


def _together(fps: DataFrame) -> np.ndarray:
    """How often bits i and j are set together, over all fingerprints."""

    def run(batches):
        total = np.zeros((_BITS, _BITS))
        for batch in batches:
            bits = np.unpackbits(
                np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint8), bitorder="little"
            ).reshape(-1, _BITS).astype(np.float32)
            total += bits.T @ bits
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i * _BITS + j), pa.array(total[i, j].astype(np.int64))], ["ij", "n"]
        )

    out = np.zeros(_BITS * _BITS)
    for r in fps.select("fp").mapInArrow(run, "ij long, n long").groupBy("ij").agg(F.sum("n").alias("n")).collect():
        out[r.ij] = r.n
    return out.reshape(_BITS, _BITS)


def partitions(together: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """Correlated bits go into the same part, so that the parts differ as independently as they can."""
    p = np.diag(together) / max(1, total)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    close = np.abs(together / max(1, total) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(close, 0)
    free, out = set(range(_BITS)), []
    for k in range(parts):
        width = _BITS * (k + 1) // parts - _BITS * k // parts
        left = sorted(free)
        part = [max(left, key=lambda b: (close[b, left].max(), -b))]
        while len(part) < width:
            left = sorted(free - set(part))
            part.append(max(left, key=lambda b: (close[b, part].sum(), -b)))
        free -= set(part)
        out.append(sorted(part))
    return out


def _values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    fps = fps.view(np.uint64)
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def thresholds(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Least total cost of thresholds t_i >= -1 with sum(t_i + 1) = distance + 1, by dynamic programming.

    ``costs[i][u]`` is the cost of part i with threshold u - 1; u = 0 leaves the part out. If every part
    differed in more than t_i bits, all would differ in more than ``distance``.
    """
    best = {0: (0.0, [])}
    for cost in costs:
        reached: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for u in range(distance + 2 - used):
                new = (spent + cost[u], [*chosen, u - 1])
                if used + u not in reached or new[0] < reached[used + u][0]:
                    reached[used + u] = new
        best = reached
    return best[distance + 1]


def _layout(
    fps: DataFrame, distance: int, total: int, crowd: int
) -> tuple[list[list[int]], list[int], dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The parts, their thresholds, and per part the values that too many fingerprints have, each with
    whether it is far too many.

    Candidates are estimated over all fingerprints: pairs of equal values exactly from the counts of
    the values, pairs t bits apart by the share that bits of these frequencies would give.
    """
    together = _together(fps)
    layouts = [partitions(together, total, m) for m in range(2, distance + 2)] or [[list(range(_BITS))]]
    parts = [bits for layout in layouts for bits in layout]

    def run(batches):
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy())
            for k, bits in enumerate(parts):
                value, n = np.unique(_values(fp, bits), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(value), k, np.int32)), pa.array(value), pa.array(n)], ["part", "value", "n"]
                )

    counts = fps.select("fp").mapInArrow(run, "part int, value long, n long").groupBy("part", "value").agg(
        F.sum("n").alias("n")
    )
    # at most _HEAVY values of a part can pass this, whatever the data
    heavy = max(crowd, total // _HEAVY)
    found = counts.groupBy("part").agg(
        F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"),
        F.collect_list(F.when(F.col("n") > heavy, F.struct("value", "n"))).alias("heavy"),
    ).collect()
    pairs, often = {r.part: float(r.pairs) for r in found}, {r.part: r.heavy for r in found}
    p = np.diag(together) / max(1, total)
    best, k = None, 0
    for layout in layouts:
        costs = []
        for j, bits in enumerate(layout):
            apart = np.zeros(distance + 2)  # chance that the part differs in t bits
            apart[0] = 1
            for b in bits:
                q = 2 * p[b] * (1 - p[b])
                apart[1:] = apart[1:] * (1 - q) + apart[:-1] * q
                apart[0] *= 1 - q
            equal = max(pairs[k + j], total * (total - 1) / 2 * apart[0])
            near = equal * apart / max(apart[0], 1e-300)
            near = np.minimum(near, total * (total - 1) / 2)
            # a probe is a row that is shuffled and sorted, a candidate one comparison
            probes = np.cumsum([0.5 * comb(len(bits), t) + 0.5 * (t == 0) for t in range(distance + 1)])
            costs.append([0.0, *(30 * total * probes[t] + near[: t + 1].sum() for t in range(distance + 1))])
        cost, chosen = thresholds(costs, distance)
        if best is None or cost < best[0]:
            best = (cost, layout, chosen, {j: often[k + j] for j in range(len(layout))})
        k += len(layout)
    crowded = {}
    for j, rows in best[3].items():
        rows = sorted((r.value, r.n > _FAR * heavy) for r in rows)
        crowded[j] = (np.array([v for v, _ in rows], np.int64), np.array([far for _, far in rows], bool))
    return best[1], best[2], crowded


def _signatures(layout, chosen, heavy, distance):
    """Rows of the index and probes of every fingerprint: (part, value, sub, fp, probe).

    A probe changes up to t bits of the part's value, and only where the lowest changed bit was 0, so
    that of two fingerprints just one meets the other. Rows of a value that too many fingerprints have
    are dealt once more by the other bits: two near ones agree in one of distance + 1 groups of them,
    and, where far too many have the value, in two of distance + 2 groups.
    """
    rest = {j: [b for b in range(_BITS) if b not in set(bits)] for j, bits in enumerate(layout)}
    once = {j: [rest[j][s :: distance + 1] for s in range(distance + 1)] for j in rest}
    groups = {j: [rest[j][s :: distance + 2] for s in range(distance + 2)] for j in rest}
    twice = {j: [x + y for x, y in combinations(groups[j], 2)] for j in rest}

    def rows_of(part, value, fp, probe):
        crowded, far = heavy[part]
        at = np.searchsorted(crowded, value)
        hot = crowded[np.minimum(at, len(crowded) - 1)] == value if len(crowded) else np.zeros(len(value), bool)
        yield part, value[~hot], np.full((~hot).sum(), -1, np.int64), fp[~hot], probe
        if hot.any():
            deep = np.zeros(len(value), bool)
            deep[hot] = far[at[hot]]
            for rows, subs in ((hot & ~deep, once[part]), (deep, twice[part])):
                for s, bits in enumerate(subs if rows.any() else ()):
                    yield part, value[rows], _values(fp[rows], bits) * len(subs) + s, fp[rows], probe

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = np.ascontiguousarray(batch.column(0).slice(at, 4096).to_numpy())
                out = []
                for part, (bits, most) in enumerate(zip(layout, chosen, strict=True)):
                    if most < 0:
                        continue
                    value = _values(fp, bits)
                    out += rows_of(part, value, fp, False)
                    for t in range(1, most + 1):
                        for flipped in combinations(range(len(bits)), t):
                            mask = sum(1 << b for b in flipped)
                            low = (value >> flipped[0]) & 1 == 0
                            out += rows_of(part, value[low] ^ mask, fp[low], True)
                for i in range(0, len(out), 256):
                    block = out[i : i + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([np.full(len(b[1]), b[0], np.int8) for b in block])),
                            *(pa.array(np.concatenate([b[c] for b in block])) for c in (1, 2, 3)),
                            pa.array(np.concatenate([np.full(len(b[1]), b[4], bool) for b in block])),
                        ],
                        ["part", "value", "sub", "fp", "probe"],
                    )

    return run


def _linked(fp: np.ndarray, probe: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Stars that join all rows of one group that links join; probes are compared with index rows only.

    Every row that is reached leaves the rows to compare with, so copies of one text cost little.
    """
    out = []
    index, probes = np.unique(fp[~probe]), np.unique(fp[probe])
    while len(index):
        seed, index = index[0], index[1:]
        reached, waiting = [], [(np.array([seed]), True)]
        while waiting:
            frontier, from_index = waiting.pop()
            for x in frontier:
                near = np.bitwise_count((index ^ x).view(np.uint64)) <= distance
                if near.any():
                    waiting.append((index[near], True))
                    reached.append(index[near])
                    index = index[~near]
                if from_index and len(probes):
                    near = np.bitwise_count((probes ^ x).view(np.uint64)) <= distance
                    if near.any():
                        waiting.append((probes[near], False))
                        reached.append(probes[near])
                        probes = probes[~near]
        if reached:
            other = np.concatenate(reached)
            out.append((np.full(len(other), seed), other))
    return out


def _verified(distance: int):
    """Groups come sorted by part, value, sub; small ones are compared all at once."""

    def links(part, value, sub, fp, probe):
        changed = (part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (sub[1:] != sub[:-1])
        first = np.flatnonzero(np.r_[True, changed])
        size = np.diff(np.r_[first, len(fp)])
        held = np.add.reduceat((~probe).astype(np.int64), first)
        live = (held > 0) & (size > 1)
        a, b = [], []
        small = live & (size <= 64)
        starts, sizes = first[small], size[small]
        for at in range(0, len(starts), 2048):
            s, n = starts[at : at + 2048], sizes[at : at + 2048]
            # every row with every later row of its group
            row = np.repeat(s, n) + _ramp(n)
            left = np.repeat(s + n, n) - row - 1
            i = np.repeat(row, left)
            j = i + 1 + _ramp(left)
            near = ~(probe[i] & probe[j])
            i, j = i[near], j[near]
            near = (np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= distance) & (fp[i] != fp[j])
            a.append(fp[i[near]])
            b.append(fp[j[near]])
        for s, n in zip(first[live & ~small].tolist(), size[live & ~small].tolist(), strict=True):
            for x, y in _linked(fp[s : s + n], probe[s : s + n], distance):
                a.append(x)
                b.append(y)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            part, value, sub = columns[:3]
            if not len(part):
                continue
            same = (part == part[-1]) & (value == value[-1]) & (sub == sub[-1])
            cut = int(np.flatnonzero(same)[0])
            held = [c[cut:] for c in columns]
            if cut:
                yield links(*(c[:cut] for c in columns))
        if held is not None and len(held[0]):
            yield links(*held)

    return run


def _ramp(n: np.ndarray) -> np.ndarray:
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def similar_links(fps: DataFrame, distance: int, crowd: int = 1024) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fps.fp`` at most ``distance`` bits apart.

    ``fps`` holds distinct fingerprints. The 64 bits are grouped into parts; part i has a threshold t_i
    with sum(t_i + 1) = distance + 1, so a pair within ``distance`` is within t_i in some part. Number
    of parts and thresholds are the cheapest by the estimated candidates. All rows that share a part's
    value, or come to it by t_i changed bits, meet in one group and are compared over all 64 bits.
    Values that more than ``crowd`` fingerprints (and a hundred-thousandth of all) have are dealt once more
    by other bits, and by twice as many bits where far more have them. Within a group of many the links form stars, so that copies don't give a row for every
    pair.
    """
    total = fps.count()
    if not total:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    layout, chosen, heavy = _layout(fps, distance, total, crowd)
    signatures = fps.select("fp").mapInArrow(
        _signatures(layout, chosen, heavy, distance), "part byte, value long, sub long, fp long, probe boolean"
    )
    return (
        signatures.repartition("part", "value", "sub")
        .sortWithinPartitions("part", "value", "sub")
        .mapInArrow(_verified(distance), "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, words: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id) of every row: fingerprints link at ``distance`` or fewer differing bits.

    Texts are lower-cased in A-Z and cut at ASCII white space; a text of fewer than ``words`` words is
    one shingle, one without words has fingerprint 0 and links like any other. component_id is the
    least doc_id that links reach, its own included. Equal fingerprints are one row of the search, so
    thousands of copies cost one. A null id takes a component's least id, and leaves it null where no
    row has one. Rows with equal ids are kept. Other columns aren't read.
    """
    prints = written(fingerprints(docs, words, id_col, text_col))
    fps = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(similar_links(fps, distance))
    members = fps.join(roots, fps.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    members = written(members)
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(members.join(least, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
