"""Runs of words that several texts have, found by the hashes of their windows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import Sieve, rows, written

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x5851F42D4C957F2D
_PLACE = np.uint64((1 << 24) - 1)  # low bits of a sampling key: place in the slice

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NEXT_SPACE = re.compile(rb"[\x09-\x0d\x20]")

_tables: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64; a worker keeps the longest it has made."""
    found = _tables.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, 1 << 16), base, np.uint64)
        found[0] = 1
        _tables[base] = found = np.multiply.accumulate(found)
    return found[:n]


class Sums:
    """Hashes of all runs of an array from sums over its prefixes."""

    def __init__(self, values: np.ndarray) -> None:
        self.back = powers(len(values) + 1, pow(_BASE, -1, 1 << 64))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(len(values) + 1, _BASE)[:-1], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        """A 64-bit hash of the run from each start up to its end."""
        out = (self.sums[end] - self.sums[start]) * self.back[start] + np.uint64(salt) * _M1
        out ^= out >> np.uint64(29)
        out *= _M2
        out ^= out >> np.uint64(32)
        return out


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash. Words are runs of bytes other than blanks and 9 to 13."""
    codes = np.frombuffer(raw, np.uint8)
    edge = np.diff(_SPACE[codes].view(np.int8), prepend=1, append=1)
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return start, Sums((codes + np.uint64(1)) * _M2).hashes(start, end)


class Windows:
    """All windows of ``words`` words of some texts, each with the anchor by which it is sampled.

    A window's anchor is the run of ``core`` words, of those it holds, that has the least hash: equal
    windows have the same one at the same place.
    """

    def __init__(self, hashes: np.ndarray, owner: np.ndarray, words: int, core: int) -> None:
        n = max(0, len(hashes) - words + 1)
        first = np.arange(n)
        first = first[owner[: n] == owner[words - 1 :]] if n else first
        sums = Sums(hashes)
        self.owner = owner[first]
        self.window = sums.hashes(first, first + words, 1).view(np.int64)
        places = np.arange(max(0, len(hashes) - core + 1))
        self.core = sums.hashes(places, places + core).view(np.int64)
        key = (self.core.view(np.uint64) & ~_PLACE) | places.astype(np.uint64)
        span, width = words - core + 1, 1
        while 2 * width <= span and len(key) > width:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if n:
            key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
        self.anchor = (key[first] & _PLACE).astype(np.int64) if n else first


def slices(batches, words: int, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, hashes of words, row of each word); a text of more than ``most`` bytes comes in several slices,
    which repeat the last ``words`` - 1 words: every window is in one slice."""
    for part in rows(batches, "data", most):
        whole, owners = [], []
        for i, data in enumerate(part.column("data").to_pylist()):
            if len(data) <= most:
                whole.append(data)
                owners.append(i)
                continue
            at, carried = 0, np.zeros(0, np.uint64)
            while at < len(data):
                found = _NEXT_SPACE.search(data, at + most)
                end = found.start() if found else len(data)
                hashes = np.concatenate([carried, word_hashes(data[at:end])[1]])
                yield part, hashes, np.full(len(hashes), i)
                at, carried = end, hashes[max(0, len(hashes) - words + 1) :]
        if whole:
            start, hashes = word_hashes(b" ".join(whole))
            ends = np.cumsum([len(data) + 1 for data in whole])
            yield part, hashes, np.array(owners)[np.searchsorted(ends, start, "right")]


def shared_passages(texts: DataFrame, keep: Callable, words: int, core: int = 16, most: int = 1 << 19) -> DataFrame:
    """(a, b, n_windows, n_shared) of the texts with a window of ``words`` words: how many they have, and how
    many of them another text has, too.

    ``texts`` (a, b, h, data) are distinct, of those that ``keep`` lets through. Only windows are compared
    whose anchor occurs again: their hashes, combined by text before the shuffle, tell which ones two texts
    have. So a passage costs as many rows as it has windows, in however many texts it is.
    """

    def anchors(batches):
        for _, hashes, owner in slices(keep(batches), words, most):
            found = Windows(hashes, owner, words, core)
            h, n = np.unique(found.core[np.unique(found.anchor)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])

    counted = texts.select("h", "data").mapInArrow(anchors, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    again = Sieve(written(counted.filter("n > 1").select("h")), "h")

    def windows(batches):
        for part, hashes, owner in slices(keep(batches), words, most):
            found = Windows(hashes, owner, words, core)
            text, n = np.unique(found.owner, return_counts=True)
            some = again.passes(found.core[found.anchor])
            both = np.unique(np.stack([found.owner[some], found.window[some]]), axis=1, return_counts=True)
            at = np.concatenate([text, both[0][0]])
            window = pa.array(np.concatenate([np.zeros(len(text), np.int64), both[0][1]]), mask=np.arange(len(at)) < len(text))
            a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
            columns = [pa.array(a[at]), pa.array(b[at]), window, pa.array(np.concatenate([n, both[1]]))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "w", "n"])

    found = written(texts.select("a", "b", "h", "data").mapInArrow(windows, "a long, b long, w long, n long"))
    seen = found.filter("w IS NOT NULL").withColumn("text", F.xxhash64("a", "b"))
    several = seen.groupBy("w").agg(F.min("text").alias("low"), F.max("text").alias("high")).filter("low <> high")
    shared = seen.join(several.select("w"), "w").groupBy("a", "b").agg(F.sum("n").alias("n_shared"))
    total = found.filter("w IS NULL").groupBy("a", "b").agg(F.sum("n").alias("n_windows"))
    return written(total.join(shared, ["a", "b"], "left").fillna(0, ["n_shared"]))
