"""Benchmark decontamination by the q-gram lemma over diagonal bands, verified by banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loanstrata.llm.common import maybe_in, rows, written

_NONE = 0x110000  # no character: stands between texts
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def normalised(text: str | None) -> np.ndarray:
    """Code points of the text in lower case, every run of white space one blank."""
    return _codes(_plain(text))


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram."""
    out = np.zeros(max(0, len(codes) - q + 1), np.uint64)
    for k in range(q):
        out = (out ^ codes[k : k + len(out)].astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


class Index:
    """Windows of the items, and for every q-gram the items and places that have it.

    An item is covered by windows of ``window`` characters, an eighth of a window apart; a shorter item
    is one window. A window of w characters allows e = ``error`` * w edits (fewer for short ones, so that the
    count below is at least one): a text region within e edits shares w + 1 - q * (e + 1) q-grams with
    it, on at most e + 1 neighbouring diagonals.
    """

    BAND = 16
    #: Pairs of a q-gram in the text and its place in an item that are held at a time.
    STEP = 1_000_000

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int, error: float, q: int) -> None:
        self.q, self.items, self.texts = q, [item for item, _ in items], [codes for _, codes in items]
        grams = [_grams(codes, q) for codes in self.texts]
        sizes = np.array([len(g) for g in grams])
        gram = np.concatenate(grams)
        place, owner = _ramp(sizes), np.repeat(np.arange(len(items)), sizes)
        order = np.argsort(gram, kind="stable")
        self.place, self.owner = place[order], owner[order]
        self.gram, self.first, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.gram >> np.uint64(44)).astype(np.int64)] = True
        lengths = np.array([len(codes) for codes in self.texts])
        #: of each item: the width of its windows, the edits they allow, the q-grams that must be shared
        self.widths = np.minimum(window, lengths)
        self.budgets = np.minimum((error * self.widths).astype(np.int64), self.widths // q - 1)
        self.shared = self.widths + 1 - q * (self.budgets + 1)
        starts = []
        for last in (lengths - self.widths).tolist():
            starts.append(np.array(sorted({*range(0, last, max(1, window // 8)), last})))
        self.item = np.repeat(np.arange(len(items)), [len(x) for x in starts])
        self.start = np.concatenate(starts)
        #: windows in order: by item, then by start
        self.span = int(lengths.max()) + 1
        self.sorted = self.item * self.span + self.start
        self.width, self.edits, self.least = (x[self.item] for x in (self.widths, self.budgets, self.shared))
        rows = zip(self.item.tolist(), self.start.tolist(), self.width.tolist(), strict=True)
        self.codes = [self.texts[i][s : s + w] for i, s, w in rows]

    def matches(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, item number, least edits) of every window that a region of a text matches."""
        gap = np.full(int(self.edits.max()) + 1, _NONE, "<u4")
        parts, starts, at = [gap], [], len(gap)
        for codes in texts:
            starts.append(at)
            parts += [codes, gap]
            at += len(codes) + len(gap)
        codes = np.concatenate(parts)
        window, band = self._bands(_grams(codes, self.q), len(codes))
        if not len(window):
            return (np.zeros(0, np.int64),) * 3
        edits, end = np.full(len(window), 1 << 20), np.zeros(len(window), np.int64)
        for w, e in set(zip(self.width[window].tolist(), self.edits[window].tolist(), strict=True)):
            some = np.flatnonzero((self.width[window] == w) & (self.edits[window] == e))
            for k in range(0, len(some), 2048):
                part = some[k : k + 2048]
                edits[part], end[part] = self._align(codes, window[part], band[part], w, e)
        good = edits <= self.edits[window]
        window, edits = window[good], edits[good]
        owner = np.searchsorted(starts, end[good] - 1, "right") - 1
        # neighbouring bands, or several regions of a text, may have the same window
        order = np.lexsort((edits, window, owner))
        owner, window, edits = owner[order], window[order], edits[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (window[1:] != window[:-1])
        return owner[new], self.item[window[new]], edits[new]

    def _hits(self, spots: np.ndarray, found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in the text, item, place in the item) of all shared q-grams, some at a time.

        A text of one character repeated shares all its q-grams with all of an item."""
        step = np.cumsum(self.count[found]) // self.STEP
        for k in range(int(step[-1]) + 1 if len(step) else 0):
            i, f = spots[step == k], found[step == k]
            times = self.count[f]
            row = np.repeat(self.first[f], times) + _ramp(times)
            yield np.repeat(i, times), self.owner[row], self.place[row]

    def _bands(self, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows and diagonal bands with enough shared q-grams; neighbouring bands overlap by e.

        What any window of an item shares with a region lies in one of the item's own diagonal bands of
        twice the size, which overlap by a band and e. Most q-grams that are shared by chance are alone
        there, so only those of bands with enough of them are counted window by window.
        """
        spots = np.flatnonzero(self.seen[(grams >> np.uint64(44)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.gram, grams[spots]), len(self.gram) - 1)
        exact = self.gram[found] == grams[spots]
        spots, found = spots[exact], found[exact]
        wide = 2 * self.BAND
        before = self.span // wide + 2
        number = n // wide + before + 2

        def wide_bands(i, owner, place):
            diagonal = i - place
            key = owner * number + diagonal // wide + before
            return key, diagonal % wide < self.BAND + self.budgets[owner]

        counted = []
        for i, owner, place in self._hits(spots, found):
            key, again = wide_bands(i, owner, place)
            counted.append(np.concatenate([key, key[again] - 1]))
        key, count = _counted(counted)
        crowded = key[count >= self.shared[key // number]]
        if not len(crowded):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)

        shift = int(self.width.max()) // self.BAND + 2
        bands = n // self.BAND + shift + 2
        counted = []
        for i, owner, place in self._hits(spots, found):
            key, again = wide_bands(i, owner, place)
            some = _among(key, crowded) | (again & _among(key - 1, crowded))
            i, owner, place = i[some], owner[some], place[some]
            # the windows of the item that hold the q-gram
            begin = owner * self.span
            low = np.searchsorted(self.sorted, begin + np.maximum(place + self.q - self.widths[owner], 0))
            times = np.searchsorted(self.sorted, begin + place, "right") - low
            for part in range(0, len(i), self.STEP // 8):
                cut = slice(part, part + self.STEP // 8)
                window = np.repeat(low[cut], times[cut]) + _ramp(times[cut])
                diagonal = np.repeat((i - place)[cut], times[cut]) + self.start[window]
                key = window * bands + diagonal // self.BAND + shift
                counted.append(np.concatenate([key, key[diagonal % self.BAND < self.edits[window]] - 1]))
        key, count = _counted(counted)
        window, band = key // bands, key % bands - shift
        enough = count >= self.least[window]
        return window[enough], band[enough]

    def _align(self, codes, window, band, w: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each whole window against the text along its band, and where the region ends.

        Costs of up to e are exact; greater ones may come out too great."""
        width = self.BAND + 3 * e
        low = band * self.BAND - e
        # a column for each window, so that every step is over all of them
        pattern = np.stack([self.codes[k] for k in window], 1)
        at = low + np.arange(w + width)[:, None]
        text = np.where((at >= 0) & (at < len(codes)), codes[np.clip(at, 0, len(codes) - 1)], _NONE)
        cost = np.zeros((width, len(window)), np.int16 if w + width < 2**15 else np.int32)
        for k in range(w):
            new = cost + (text[k : k + width] != pattern[k])
            np.minimum(new[:-1], cost[1:] + 1, out=new[:-1])
            # characters that only the text has; more than e in a row decide nothing
            step = 1
            while step <= e:
                new[step:] = np.minimum(new[step:], new[:-step] + step)
                step *= 2
            cost = new
        best = cost.argmin(0)
        return cost[best, np.arange(len(window))], low + best + w


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and how often each comes."""
    if len(parts) == 1:
        return np.unique(parts[0], return_counts=True)
    found = [np.unique(p, return_counts=True) for p in parts]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return key, np.bincount(where, weights=np.concatenate([c for _, c in found])).astype(np.int64)


def _among(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted table."""
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _blocks(
    benchmark: DataFrame, item_col: str, text_col: str, window: int, least: int, most: int
) -> tuple[int, Iterator[list]]:
    """The number of blocks of items that say something, and the blocks: of about ``most`` characters.

    One block at a time is brought to the driver. A larger benchmark is dealt out by hash, and an item
    that alone makes up much of a block is cut into pieces, which have each of its windows once."""
    given = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    count = math.ceil((given.agg(F.sum(F.length("text"))).first()[0] or 0) / most)
    if count <= 1:
        block = [(r.item, codes) for r in given.collect() if len(codes := normalised(r.text)) >= least]
        return int(bool(block)), iter([block])
    step = max(1, window // 8)
    size = max(most // 8 // step, 2 * window // step + 2) * step

    def cut(batches):
        for batch in batches:
            items, pieces = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = _plain(text)
                # a rest of less than a window lies in the piece before
                for at in range(0, max(1, len(text) - 2 * window), size):
                    items.append(i)
                    last = at + size >= len(text) - 2 * window
                    pieces.append(text[at:] if last else text[at : at + size + window - step])
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(items, pa.int64())), pa.array(pieces, pa.string())], ["item", "text"])

    kind = benchmark.schema[item_col].dataType.simpleString()
    dealt = written(
        given.mapInArrow(cut, f"item {kind}, text string")
        .filter(F.length("text") >= least)
        .withColumn("block", F.pmod(F.xxhash64("text"), F.lit(count)))
    )

    def blocks():
        for k in range(count):
            block = [(r.item, _codes(r.text)) for r in dealt.filter(F.col("block") == k).collect()]
            if block:
                yield block

    return count, blocks()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 64,
    error: float = 0.1,
    q: int = 8,
    least: int = 25,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = 1_000_000,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, columns to ``carry``, contaminated, item_ids, n_windows, least_edits) of every row.

    A document is contaminated if some region of it is within the edit budget of a window of a
    benchmark item (`Index`), both in lower case with single blanks. A passage of nine eighths of a
    window (72 characters) holds a whole window wherever it lies in its item. It is found if a window
    that it holds has at most ``error`` of its characters edited (six of 64).
    Items shorter than ``least`` characters say nothing and match nothing. ``item_ids`` lists the
    matched items in order, ``n_windows`` counts the windows found, ``least_edits`` is null if there are none.

    The benchmark goes to the tasks in blocks of about ``block_chars`` characters, of which driver and
    tasks hold one at a time; documents are read once for each block. For one block they aren't
    shuffled at all, for several only what they found is brought together. Null and empty texts are
    clean; equal and null ids and repeated rows are kept; an empty benchmark leaves all clean; other
    columns aren't read, and a carried column of one of these names gives way.
    """
    results = ["doc_id", "contaminated", "item_ids", "n_windows", "least_edits"]
    carried = [c for c in carry if c not in results]
    item_type = benchmark.schema[item_col].dataType
    schema = T.StructType([T.StructField("_uid", T.LongType()), T.StructField("doc_id", docs.schema[id_col].dataType)])
    for c in carried:
        schema.add(c, docs.schema[c].dataType)
    for c, kind in (("item_ids", T.ArrayType(item_type)), ("n_windows", T.IntegerType()), ("least_edits", T.IntegerType())):
        schema.add(c, kind)
    item_arrow = pa.list_(to_arrow_type(item_type))
    keyed = docs.select(
        F.monotonically_increasing_id().alias("_uid"),
        F.col(id_col).alias("doc_id"),
        *(F.col(c).alias(f"c{k}") for k, c in enumerate(carried)),
        F.col(text_col).alias("text"),
    )

    def search(block, hits_only=False):
        def run(batches):
            index = Index(block.value, window, error, q)
            for part in rows(batches, "text", 1_000_000):
                texts = [normalised(t) for t in part.column("text").to_pylist()]
                owner, item, edits = index.matches(texts)
                ids, n, best = [[] for _ in texts], [0] * len(texts), [None] * len(texts)
                for o, i, e in zip(owner.tolist(), item.tolist(), edits.tolist(), strict=True):
                    ids[o].append(index.items[i])
                    n[o] += 1
                    best[o] = e if best[o] is None else min(best[o], e)
                columns = [part.column(k) for k in range(1 if hits_only else 2 + len(carried))]
                columns.append(pa.array([sorted(set(x), key=lambda v: (v is None, v)) for x in ids], item_arrow))
                columns += [pa.array(n, pa.int32()), pa.array(best, pa.int32())]
                names = [schema.names[0], *schema.names[-3:]] if hits_only else schema.names
                found = pa.RecordBatch.from_arrays(columns, names)
                yield found.filter(pc.greater(found.column("n_windows"), 0)) if hits_only else found

        return run

    broadcast = docs.sparkSession.sparkContext.broadcast
    count, blocks = _blocks(benchmark, item_col, item_text_col, window, least, block_chars)
    nothing = (
        F.array().cast(T.ArrayType(item_type)).alias("item_ids"),
        F.lit(0).alias("n_windows"),
        F.lit(None).cast("int").alias("least_edits"),
    )
    named = ["_uid", "doc_id", *(F.col(f"c{k}").alias(c) for k, c in enumerate(carried))]
    if count == 0:
        out = keyed.select(*named, *nothing)
    elif count == 1:
        out = keyed.mapInArrow(search(broadcast(next(blocks))), schema)
    else:
        # written, so that a number names the same row in the pass of every block
        keyed = written(keyed)
        hits_schema = T.StructType([schema[0], *schema[-3:]])
        found = []
        for block in blocks:
            sent = broadcast(block)
            found.append(written(keyed.mapInArrow(search(sent, hits_only=True), hits_schema)))
            sent.destroy()
        hits = reduce(DataFrame.unionByName, found, docs.sparkSession.createDataFrame([], hits_schema))
        hits = written(
            hits.groupBy("_uid").agg(
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
                F.sum("n_windows").cast("int").alias("n_windows"),
                F.min("least_edits").alias("least_edits"),
            )
        )
        some, others = maybe_in(keyed.drop("text"), hits, ["_uid"])
        joined = some.select(*named).join(hits, "_uid", "left")
        empty = [F.coalesce("item_ids", nothing[0]).alias("item_ids"), F.coalesce("n_windows", F.lit(0)).alias("n_windows")]
        joined = joined.select(*schema.names[:-3], *empty, "least_edits")
        out = others.select(*named, *nothing).unionByName(joined)
    return out.select(
        "doc_id", *carried, (F.col("n_windows") > 0).alias("contaminated"), "item_ids", "n_windows", "least_edits"
    )
