"""Suffix-array dedup: a distributed merge sort of suffixes that never compares a known prefix twice."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import Sieve, maybe_in, rows, small_batches, text_key, written
from loanstrata.llm.passages import powers, shared_passages

_GRAM = 16
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x5851F42D4C957F2D
_PLACE = 24  # low bits of a sampling key: place in the slice


class Texts:
    """Pieces of texts end to end, their window starts sampled by content.

    A window is ``length`` bytes. Its anchor is the least 16-gram, by hash, that begins in its first
    half (leftmost if equal), so equal windows have their anchor at the same place. Windows with one
    anchor a are a run of starts [lo, hi]; o = a - start is a window's offset. A piece (text, place in
    it, from, to, bytes) keeps the runs whose anchors are from ``from`` on and before ``to``.
    """

    def __init__(self, pieces: list[tuple[int, int, int, int, bytes]], length: int) -> None:
        self.length, self.span = length, length // 2
        self.raw = b"".join(p[4] for p in pieces)
        sizes = np.array([len(p[4]) for p in pieces], np.int64)
        self.ends = np.cumsum(sizes)
        begins = self.ends - sizes
        n = np.maximum(sizes - length + 1, 0)
        starts = np.repeat(begins, n) + _ramp(n)
        codes = np.frombuffer(self.raw, np.uint8)
        anchor = self._anchors(codes)[starts] if len(starts) else starts
        new = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(np.r_[np.ones(min(1, len(starts)), bool), new])
        last = np.r_[first[1:], len(starts)][: len(first)] - 1
        self.anchor, self.lo, self.hi = anchor[first], starts[first], starts[last]
        piece = np.searchsorted(self.ends, self.lo, "right")
        text, place, low, high = (np.array([p[k] for p in pieces], np.int64)[piece] for k in range(4))
        self.begin, self.end = begins[piece], self.ends[piece]
        #: what to add to a place here to get the place in the text
        self.shift = place - self.begin
        self.text = text
        keep = (self.anchor + self.shift >= low) & (self.anchor + self.shift < high)
        for name in ("anchor", "lo", "hi", "begin", "end", "shift", "text"):
            setattr(self, name, getattr(self, name)[keep])
        self.back = powers(len(codes) + 1, pow(_BASE, -1, 1 << 64))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * _M2 * powers(len(codes) + 1, _BASE)[:-1], out=self.sums[1:])

    def _anchors(self, codes: np.ndarray) -> np.ndarray:
        """For every place the place of the least 16-gram that begins in the half window from there on."""
        n = len(codes) - 7
        eight = np.empty(n, np.uint64)
        for r in range(8):
            eight[r::8] = np.frombuffer(self.raw, "<u8", (len(codes) - r) // 8, r)
        key = eight[:-8] * _M1
        key ^= key >> np.uint64(31)
        key += eight[8:]
        key *= _M2
        key ^= key >> np.uint64(32)
        key *= _M1
        key &= ~np.uint64((1 << _PLACE) - 1)
        key |= np.arange(len(key), dtype=np.uint64)
        width = 1
        while 2 * width <= self.span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        more = self.span - width
        key = np.minimum(key[: len(key) - more], key[more:])
        return (key & np.uint64((1 << _PLACE) - 1)).astype(np.int64)

    def hashes(self, start: np.ndarray, size, salt=0) -> np.ndarray:
        """A 64-bit hash of the ``size`` bytes at each start."""
        out = (self.sums[start + size] - self.sums[start]) * self.back[start] + np.uint64(salt) * _M1
        out ^= out >> np.uint64(29)
        out *= _M2
        out ^= out >> np.uint64(32)
        return out.view(np.int64)

    def cores(self) -> np.ndarray:
        """Of each anchor the bytes that all its windows have in common, were the run complete."""
        return self.hashes(self.anchor, self.length - self.span + 1)

    def cells(self, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """The runs ``which`` cut by offset into cells: (run, base, first start, last start, hash).

        ``base`` is the start of the cell's least offset, complete or not."""
        size = max(1, self.span // 8)
        first = (self.anchor[which] - self.hi[which]) // size
        n = (self.anchor[which] - self.lo[which]) // size - first + 1
        run = np.repeat(which, n)
        cell = np.repeat(first, n) + _ramp(n)
        base = self.anchor[run] - cell * size
        lo, hi = np.maximum(self.lo[run], base - size + 1), np.minimum(self.hi[run], base)
        return run, base, lo, hi, self.hashes(base, self.length - size + 1, 1) + cell

    def singles(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All starts of some runs, with the hash of their window."""
        start = np.repeat(lo, hi - lo + 1) + _ramp(hi - lo + 1)
        return start, self.hashes(start, self.length, 2)


def _ramp(n: np.ndarray) -> np.ndarray:
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class Plan:
    """Which windows are worth sorting: those whose core another window has, at the level that keeps
    the groups of equal cores small. Sieves let some more through, the same ones everywhere."""

    def __init__(self) -> None:
        self.again: list[Sieve] = []
        self.crowded: list[Sieve] = []

    def level(self, texts: Texts, level: int) -> np.ndarray:
        """Hashes of the cores at this level, of what is crowded on the levels above."""
        if level == 0:
            return texts.cores()
        run, base, lo, hi, core = texts.cells(np.flatnonzero(self.crowded[0].passes(texts.cores())))
        if level == 1:
            return core
        crowded = self.crowded[1].passes(core)
        return texts.singles(lo[crowded], hi[crowded])[1]

    def items(self, texts: Texts) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(tag, run, base, first start, last start)."""
        cores = texts.cores()
        again = self.again[0].passes(cores)
        crowded = self.crowded[0].passes(cores) if self.crowded else np.zeros(len(cores), bool)
        plain = np.flatnonzero(again & ~crowded)
        yield 0, plain, texts.anchor[plain], texts.lo[plain], texts.hi[plain]
        if crowded.any():
            run, base, lo, hi, core = texts.cells(np.flatnonzero(crowded))
            again, crowded = self.again[1].passes(core), self.crowded[1].passes(core)
            plain = again & ~crowded
            yield 1, run[plain], base[plain], lo[plain], hi[plain]
            if crowded.any():
                start, whole = texts.singles(lo[crowded], hi[crowded])
                run = np.repeat(run[crowded], hi[crowded] - lo[crowded] + 1)
                again = self.again[2].passes(whole)
                yield 2, run[again], start[again], start[again], start[again]


def _common(x: bytes, y: bytes, at: int) -> int:
    """Length of the common prefix, known to be ``at`` at least."""
    n = min(len(x), len(y))
    while at < n:
        end = min(at + 64, n)
        p, q = x[at:end], y[at:end]
        if p != q:
            apart = int.from_bytes(p, "big") ^ int.from_bytes(q, "big")
            return at + (8 * (end - at) - apart.bit_length()) // 8
        at = end
    return n


def _encode(items: list[tuple]) -> tuple:
    """A sorted run, front-coded: of each string the part that its predecessor doesn't have."""
    shared, rest, before = [], [], b""
    for string, *_ in items:
        c = _common(before, string, 0)
        shared.append(c)
        rest.append(string[c:])
        before = string
    left = [i[1] for i in items]
    numbers = np.array([i[2:] for i in items], np.int64)
    return (
        np.array(shared, np.uint16).tobytes(),
        np.array([len(r) for r in rest], np.uint16).tobytes(),
        b"".join(rest),
        np.array([len(x) for x in left], np.uint16).tobytes(),
        b"".join(left),
        numbers.tobytes(),
    )


def _decode(shared, sizes, rest, left_sizes, left, numbers) -> Iterator[tuple[int, bytes, bytes, tuple]]:
    """(bytes shared with the string before, string, left context, numbers)."""
    string, at, left_at = b"", 0, 0
    for c, n, m, row in zip(
        np.frombuffer(shared, np.uint16).tolist(),
        np.frombuffer(sizes, np.uint16).tolist(),
        np.frombuffer(left_sizes, np.uint16).tolist(),
        np.frombuffer(numbers, np.int64).reshape(-1, 5).tolist(),
        strict=True,
    ):
        string = string[:c] + rest[at : at + n]
        yield c, string, left[left_at : left_at + m], row
        at, left_at = at + n, left_at + m


class LoserTree:
    """Merges sorted runs. Every waiting head knows its common prefix with the last one put out; of two
    heads the one with more in common is the lesser, and only equals are compared, from there on."""

    def __init__(self, runs: list[Iterator]) -> None:
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.head: list = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.known = [0] * self.size
        self.loser = [0] * self.size
        self.best = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        win, lose = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.loser[node] = lose
        return win

    def _play(self, i: int, j: int) -> tuple[int, int]:
        x, y = self.head[i], self.head[j]
        if x is None or y is None:
            return (j, i) if x is None else (i, j)
        known = self.known
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        c = _common(x[1], y[1], known[i])
        if x[1][c : c + 1] <= y[1][c : c + 1]:
            known[j] = c
            return i, j
        known[i] = c
        return j, i

    def __iter__(self) -> Iterator[tuple]:
        """(common prefix with the string before, string, left context, numbers) in order."""
        while self.head[self.best] is not None:
            i = self.best
            head = self.head[i]
            yield self.known[i], *head[1:]
            following = next(self.runs[i], None)
            self.head[i] = following
            self.known[i] = following[0] if following else 0
            node = (i + self.size) >> 1
            while node:
                i, self.loser[node] = self._play(i, self.loser[node])
                node >>= 1
            self.best = i


def _solve(group: list[tuple], length: int, left: int) -> Iterator[tuple[int, int, int, int]]:
    """Spans (a, b, from, to) of the windows that two or more items of a group have.

    An item is (bytes in common with the one before, is its string the same, left context, a, b, base,
    least o, greatest o), in the order of the strings. The window at offset o is the o bytes to the
    left and the length - o bytes to the right of the base. Only ``left`` offsets are open.
    """
    kept, shared, alike = [], [], {}
    right, lead = 0, length
    for item in group:
        right += not item[1]
        lead = min(lead, item[0])
        twins = alike.setdefault((right, item[2]), [])
        if not twins:
            kept.append(item)
            shared.append(lead)
            lead = length
        twins.append(item)
    for twins in alike.values():
        if len(twins) > 1:
            for *_, a, b, base, low, high in twins:
                yield a, b, base - high, base - low + length
    n = len(kept)
    if n <= 16:
        for i in range(n):
            common = length
            for j in range(i + 1, n):
                common = min(common, shared[j])
                least = length - common
                if least > left:
                    break
                most = _common(kept[i][2], kept[j][2], 0)
                for *_, a, b, base, low, high in (kept[i], kept[j]):
                    if max(low, least) <= min(high, most):
                        yield a, b, base - min(high, most), base - max(low, least) + length
        return
    # All offsets one after the other: items are in one class if both sides are equal.
    common = np.array(shared)
    order = sorted(range(n), key=lambda i: kept[i][2])
    beside = np.array([0, *(_common(kept[i][2], kept[j][2], 0) for i, j in zip(order, order[1:], strict=False))])
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    low, high = (np.array([item[c] for item in kept]) for c in (6, 7))
    repeated = np.zeros((n, left + 2), bool)
    for o in range(left + 1):
        both = np.cumsum(common < length - o) * (n + 1) + np.cumsum(beside < o)[where]
        _, back, count = np.unique(both, return_inverse=True, return_counts=True)
        repeated[:, o] = (count[back] > 1) & (low <= o) & (o <= high)
    edge = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
    for i, first in zip(*np.nonzero(edge == 1), strict=True):
        last = int(first) + int(np.argmin(repeated[i, first:])) - 1
        *_, a, b, base, _, _ = kept[i]
        yield a, b, base - last, base - int(first) + length


def _left(tag: int, length: int) -> int:
    """Offsets that a group of this tag leaves open."""
    return (length // 2 - 1, max(1, length // 16) - 1, 0)[tag]


_SEGMENT = 1 << 17


def _slices(batches, length: int) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Texts in pieces of about a segment; a longer text is cut so that every run is in one piece."""
    for part in rows(batches, "data", 2 * _SEGMENT):
        pieces, held = [], 0
        for i, data in enumerate(part.column("data").to_pylist()):
            for at in range(0, len(data), _SEGMENT):
                begin = max(0, at - length // 2)
                last = at + _SEGMENT >= len(data)
                piece = data[begin : len(data) if last else at + _SEGMENT + length]
                pieces.append((i, begin, at, at + _SEGMENT, piece))
                held += len(piece)
                if held >= 2 * _SEGMENT:
                    yield part, Texts(pieces, length)
                    pieces, held = [], 0
        if pieces:
            yield part, Texts(pieces, length)


def _merged(spans: np.ndarray) -> np.ndarray:
    """Spans (a, b, from, to) with those of one text that meet joined."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    out, (a, b, low, high) = [], spans[0].tolist()
    for x, y, p, q in spans.tolist():
        if (x, y) == (a, b) and p <= high:
            high = max(high, q)
        else:
            out.append((a, b, low, high))
            a, b, low, high = x, y, p, q
    return np.array([*out, (a, b, low, high)], np.int64)


_RUN = "p int, shared binary, sizes binary, rest binary, left_sizes binary, left binary, numbers binary"
_RUN_FIELDS = [f.split()[0] for f in _RUN.split(", ")]
_RUN_TYPE = pa.schema([("p", pa.int32()), *((f, pa.binary()) for f in _RUN_FIELDS[1:])])


def _sorted_runs(plan: Plan, splitters: list[bytes], parts: int, length: int, most: int):
    """Each task sorts the suffixes it holds, drops what its own copies decide, and front-codes the rest
    for the ranges of the splitters, each in ``parts`` parts by the hash of what all members of a group
    share: so suffixes that begin alike, but are in no group, don't have to meet. Copies within the run
    leave as spans, one of them as a string."""
    core = length - length // 2 + 1

    def flush(items: list[tuple]) -> Iterator[pa.RecordBatch]:
        items.sort(key=lambda i: i[:2])
        out, blocks, spans = [], {}, []
        for k, item in enumerate(items):
            twin = k > 0 and item[:2] == items[k - 1][:2]
            if twin or (k + 1 < len(items) and item[:2] == items[k + 1][:2]):
                _, _, a, b, base, low, high = item
                spans.append((a, b, base - high, base - low + length))
            if not twin:
                string = item[0]
                p = string[0] * (len(splitters) + 1) + bisect_left(splitters, string[1 : 1 + _prefix(length)])
                blocks.setdefault(p * parts + zlib.crc32(string[1 : 1 + core]) % parts, []).append(item)
        for p, block in blocks.items():
            out.append((p, *_encode(block)))
        if spans:
            # to the range of the task's first block, as numbers alone
            out.append((min(blocks), None, None, None, None, None, _merged(np.array(spans, np.int64)).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _RUN_TYPE.types, strict=True)], _RUN_FIELDS
        )

    def run(batches):
        items, held = [], 0
        for part, texts in _slices(batches, length):
            a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
            raw = texts.raw
            for tag, which, base, lo, hi in plan.items(texts):
                left = _left(tag, length)
                mark = bytes([tag])
                for x, y, s, begin, end, shift, low, high in zip(
                    *(c.tolist() for c in (
                        a[texts.text[which]], b[texts.text[which]], base, texts.begin[which], texts.end[which],
                        texts.shift[which], base - hi, base - lo,
                    )),
                    strict=True,
                ):
                    string = mark + raw[s : min(s + length, end)]
                    context = raw[max(begin, s - left) : s][::-1]
                    items.append((string, context, x, y, s + shift, low, high))
                    held += len(string) + len(context) + 500
            if held > most:
                yield from flush(items)
                items, held = [], 0
        if items:
            yield from flush(items)

    return run


def _prefix(length: int) -> int:
    """Bytes by which suffixes are dealt out: never more than all members of a group share."""
    return min(32, length - length // 2 + 1)


_SPAN_TYPE = pa.schema([(c, pa.int64()) for c in ("a", "b", "low", "high")])


def _merge(length: int):
    """One range of the order of all suffixes: its runs meet in a loser tree, neighbours with enough in
    common form a group."""

    def run(table: pa.Table) -> pa.Table:
        spans, runs = [], []
        for row in zip(*(table.column(c).to_pylist() for c in _RUN_FIELDS[1:]), strict=True):
            if row[0] is None:
                spans.append(np.frombuffer(row[-1], np.int64).reshape(-1, 4))
            else:
                runs.append(_decode(*row))
        found, group, before, left = [], [], 0, 0
        for common, string, context, numbers in LoserTree(runs) if runs else ():
            if common < 1 + length - left or not group:
                if len(group) > 1:
                    found += _solve(group, length, left)
                group = []
                left = _left(string[0], length)
            same = bool(group) and common == len(string) == before
            group.append((common - 1, same, context, *numbers))
            before = len(string)
        if len(group) > 1:
            found += _solve(group, length, left)
        spans.append(np.array(found, np.int64).reshape(-1, 4))
        joined = _merged(np.concatenate(spans))
        return pa.Table.from_arrays([pa.array(joined[:, c].copy()) for c in range(4)], schema=_SPAN_TYPE)

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("key"), data.alias("data")).select(
        "doc_id", "key.a", "key.b", F.octet_length("data").cast("long").alias("n_bytes"), "data"
    )


def _unless(sieve: Sieve):
    """Rows without a hash, and rows whose hash the sieve stops."""

    def keep(batches):
        for batch in batches:
            h = batch.column("h")
            maybe = sieve.passes(h.fill_null(0).to_numpy()) & h.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(~maybe))

    return keep


def _repeated_spans(
    texts: DataFrame, keep, sample: DataFrame, length: int, crowd: int, run_bytes: int
) -> DataFrame:
    """(a, b, low, high) of the bytes of distinct texts that windows with another start cover.

    The texts are those rows of ``texts`` that ``keep`` lets through. ``sample`` is a bounded number of texts that tells how to cut the order into ranges of equal size.
    """
    spark = texts.sparkSession
    plan, suffixes = Plan(), 0
    for level in range(3):

        def emit(batches, level=level):
            for _, part in _slices(keep(batches), length):
                h, n = np.unique(plan.level(part, level), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])

        again = written(
            texts.select("h", "data").mapInArrow(emit, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")
        )
        plan.again.append(Sieve(again, "h"))
        suffixes += again.agg(F.sum("n")).first()[0] or 0
        if level == 2:
            break
        crowded = again.filter(F.col("n") > crowd)
        plan.crowded.append(Sieve(crowded, "h"))
        if not plan.crowded[-1].words.any():
            break

    def prefixes(batches):
        for _, part in _slices(batches, length):
            some = part.anchor[:: max(1, len(part.anchor) // 1000)]
            yield pa.RecordBatch.from_arrays([pa.array([part.raw[s : s + _prefix(length)] for s in some.tolist()], pa.binary())], ["x"])

    ordered = sorted(r.x for r in sample.select("data").mapInArrow(prefixes, "x binary").limit(100_000).toLocalIterator())
    # as many parts as hold some RANGE_BYTES each; only the ranges have splitters, which every task has
    wanted = max(suffixes * 3 * length // (2 * RANGE_BYTES), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = min(wanted, 1024)
    splitters = sorted({ordered[len(ordered) * k // ranges] for k in range(1, ranges)}) if ordered else []

    sort = _sorted_runs(plan, splitters, -(-wanted // ranges), length, run_bytes)
    runs = texts.mapInArrow(lambda batches: sort(keep(batches)), _RUN)
    return runs.groupBy("p").applyInArrow(_merge(length), "a long, b long, low long, high long")


#: Bytes of suffixes, before they are front-coded, that meet in one merge.
RANGE_BYTES = 8_000_000


def repeats(
    docs: DataFrame,
    length: int = 400,
    crowd: int = 32_768,
    run_bytes: int = 12_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """What to remove: all bytes covered by ``length`` bytes that also start anywhere else.

    Returns written tables: documents (doc_id, a, b, n_bytes, sha256), where (a, b) stands for the
    text; copies (a, b, n_bytes), texts that several documents have, which go whole if they have ``length``
    bytes; spans (a, b, spans) of the other texts, joined where they meet, in order; and with ``words`` the
    passages of so many words that texts share (`shared_passages`).

    Texts are UTF-8 bytes, null is empty; a match may lie in one document, never across two. Repeated
    rows are copies. Ids, null or not, only name documents. Other columns aren't read.

    Equal texts are sorted once. Of the windows only those count whose core, the middle part that all
    windows with one anchor share, occurs again: hashes of cores are counted, combined before the
    shuffle, and a sieve of fixed size tells. Of these windows the suffixes at the anchors are sorted:
    each task sorts its own into runs, front-codes them, cuts them at splitters; each range merges its
    runs in a loser tree. Neighbours that share a core form a group, in which the common prefixes and
    the bytes to the left decide every window exactly. A core that more than ``crowd`` windows share is
    cut into eighths of its offsets, then into single windows, which need no group: so no group grows
    with the data. A task's copies leave its run as one string. Hashes only choose what is compared.
    """
    if length < 2 * _GRAM:
        raise ValueError(f"length must be at least {2 * _GRAM} bytes")
    with small_batches(docs.sparkSession):
        return _repeats(_keyed(docs, id_col, text_col), length, crowd, run_bytes, words)


def _repeats(keyed: DataFrame, length: int, crowd: int, run_bytes: int, words: int | None) -> tuple:
    # bytes of a text that has anything to compare
    least = min(length, 2 * words - 1) if words else length
    documents = written(keyed.select("doc_id", "a", "b", "n_bytes", F.sha2("data", 256).alias("sha256")))
    long = F.col("n_bytes") >= least
    copies = written(documents.filter(long).groupBy("a", "b", "n_bytes").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    long = keyed.filter(long).select("a", "b", "data")
    some, _ = maybe_in(long, copies, ["a", "b"])
    h = F.xxhash64("a", "b")
    # Only texts that need a shuffle to be single are written; the others are read where they lie, pass
    # by pass. They have a hash, by which the passes leave out what is written.
    apart = written(some.groupBy("a", "b").agg(F.any_value("data").alias("data")))
    texts = long.withColumn("h", h).unionByName(apart.withColumn("h", F.lit(None).cast("long")))
    keep = _unless(Sieve(copies.select(h.alias("h")), "h"))
    every = max(1, documents.count() // 1000)
    sample = long.filter(F.pmod("b", F.lit(every)) == 0).limit(2000)
    found = _repeated_spans(texts, keep, sample, length, crowd, run_bytes)

    def joined(batches):
        for batch in batches:
            out = []
            for spans in batch.column("spans").to_pylist():
                one = np.array([(0, 0, s["low"], s["high"]) for s in spans], np.int64)
                out.append([{"low": p, "high": q} for _, _, p, q in _merged(one).tolist()])
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, kind)], ["a", "b", "spans"])

    schema = "a long, b long, spans array<struct<low:long,high:long>>"
    spans = written(
        found.groupBy("a", "b").agg(F.collect_list(F.struct("low", "high")).alias("spans")).mapInArrow(joined, schema)
    )
    return documents, copies, spans, shared_passages(texts, keep, words) if words else None


def kept_digests(
    docs: DataFrame,
    length: int = 400,
    crowd: int = 32_768,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, see `repeats`.

    With ``words`` also n_shared_passages: at how many words of the text a run of so many words begins
    that another document has, too. Shorter than ``length``, such a run isn't removed."""
    documents, copies, spans, passages = repeats(docs, length, crowd, id_col=id_col, text_col=text_col, words=words)
    gone = copies.filter(F.col("n_bytes") >= length).select("a", "b")
    with small_batches(docs.sparkSession):
        cut = cut_texts(docs, gone, spans, id_col, text_col)
        cut = written(cut.select("a", "b", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))
    by_text = documents.join(copies.select("a", "b", F.lit(True).alias("copied")), ["a", "b"], "left").join(cut, ["a", "b"], "left")
    whole = F.col("copied") & (F.col("n_bytes") >= length)
    nothing = hashlib.sha256().hexdigest()
    columns = [
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, nothing).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    ]
    if passages is not None:
        by_text = by_text.join(passages, ["a", "b"], "left")
        n = F.when(F.col("copied"), F.col("n_windows")).otherwise(F.col("n_shared"))
        columns.append(F.coalesce(n, F.lit(0)).alias("n_shared_passages"))
    return by_text.select(*columns)


def cut_texts(docs: DataFrame, copies: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, kept, n_removed, n_spans) of the texts that lose some bytes but aren't in copies, by `repeats`."""
    some = spans.join(copies, ["a", "b"], "left_anti")
    texts, _ = maybe_in(_keyed(docs, id_col, text_col).select("a", "b", "data"), some, ["a", "b"])

    def cut(batches):
        for part in rows(batches, "data"):
            kept, removed, n = [], [], []
            for data, found in zip(part.column("data").to_pylist(), part.column("spans").to_pylist(), strict=True):
                at, out = 0, []
                for s in found:
                    out.append(data[at : s["low"]])
                    at = s["high"]
                out.append(data[at:])
                kept.append(b"".join(out))
                removed.append(len(data) - len(kept[-1]))
                n.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(kept, pa.binary()), pa.array(removed), pa.array(n)],
                ["a", "b", "kept", "n_removed", "n_spans"],
            )

    return texts.join(some, ["a", "b"]).select("a", "b", "data", "spans").mapInArrow(
        cut, "a long, b long, kept binary, n_removed long, n_spans long"
    )
