"""Approximate nearest neighbours: multi-index hashing over learned rotated binary codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanstrata.llm.common import written

_BITS, _PARTS = 64, 4
_WIDTH = _BITS // _PARTS


@dataclass
class Codes:
    """Bit k of a code is the sign of the k-th rotated principal direction."""

    longest: float
    mean: np.ndarray
    directions: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as 64-bit numbers. One more component makes all rows equally long, so that the
        largest inner product is the smallest angle; a query has 0 there."""
        if query:
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            extra = np.zeros(len(vectors))
        else:
            unit = vectors / self.longest
            extra = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(1)))
        bits = (np.c_[unit, extra] - self.mean) @ self.directions > 0
        packed = np.zeros((len(vectors), _BITS), bool)
        packed[:, : bits.shape[1]] = bits
        return np.packbits(packed, axis=1, bitorder="little").view("<u8").ravel()


def learn(sample: np.ndarray, longest: float, total: int, k: int, share: float, seed: int = 0) -> Codes:
    """Principal directions, rotated so that signs lose least (iterative quantisation), and the radius
    that holds ``share`` of the sample's own nearest neighbours.

    The k nearest of ``total`` rows are as near as the k * n / total nearest of n sampled ones.
    """
    unit = sample / longest
    full = np.c_[unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(1)))]
    mean = full.mean(0)
    rng = np.random.default_rng(seed)
    _, _, axes = np.linalg.svd((full - mean).T @ (full - mean), hermitian=True)
    axes = axes[: min(_BITS, full.shape[1])].T
    shown = (full - mean) @ axes
    rotation = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(30):
        u, _, v = np.linalg.svd(np.where(shown @ rotation > 0, 1.0, -1.0).T @ shown)
        rotation = (u @ v).T
    codes = Codes(longest, mean, axes @ rotation, _BITS)
    n = len(sample)
    asked = rng.permutation(n)[:512]
    near = max(1, -(-k * n // max(1, total)))
    if n > near:
        scores = sample[asked] @ sample.T
        scores[np.arange(len(asked)), asked] = -np.inf
        best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
        apart = np.bitwise_count(codes.of(sample[asked], True)[:, None] ^ codes.of(sample)[best])
        codes.radius = int(np.quantile(apart, share, method="higher"))
    return codes


class MultiIndex:
    """For each substring of the codes the rows of every value; probing retrieves every code in a radius."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.tables = codes, []
        for part in range(_PARTS):
            values = self._part(codes, part)
            order = np.argsort(values, kind="stable")
            value, first, count = np.unique(values[order], return_index=True, return_counts=True)
            self.tables.append((value, first, count, order))

    @staticmethod
    def _part(codes: np.ndarray, part: int) -> np.ndarray:
        return ((codes >> np.uint64(part * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)).astype(np.uint16)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Rows whose code differs in at most ``radius`` bits.

        If r = radius is spread over the parts, one of the first r mod parts + 1 differs in at most
        r div parts bits, or a later one in fewer. A part's values that near are looked up by a pass
        over the values there are, which are fewer than the values in such a ball.
        """
        hit = np.zeros(len(self.codes), bool)
        for part, (value, first, count, order) in enumerate(self.tables):
            most = radius // _PARTS - (part > radius % _PARTS)
            if most < 0:
                continue
            asked = self._part(np.array([code]), part)[0]
            near = np.flatnonzero(np.bitwise_count(value ^ asked) <= most)
            n = count[near]
            at = np.repeat(first[near], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hit[order[at]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    share: float = 0.97,
    fit_rows: int = 8192,
    shard_rows: int = 16_384,
    query_rows: int = 8192,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product found for each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query's
    own, also those that share its id. The codes are learned on at most ``fit_rows`` rows, chosen by a hash of the id; every row is
    indexed. Rows are dealt into shards, queries into blocks, of bounded size; each meeting of the two
    is one task. A shard retrieves all codes within the learned radius of a query's, or a larger one
    until it has ``k`` rows or all, and ranks them by the inner product of the vectors in double
    precision; the best of all shards are the result. Ties go to the smaller id. ``share`` of the
    sample's true neighbours are within the radius.

    Rows with a null id, and vectors that are null or zero, hold null or non-finite components or
    have another length than most, take no part. Several rows with one id are candidates, and queries,
    of their own. Other columns aren't read; an empty table gives no row.
    """
    x = F.col("v")
    usable = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull()
        & x.isNotNull()
        & F.exists(x, lambda e: e != 0)
        & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    )
    lengths = usable.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, e: a + e * e))).alias("longest")
    )
    common = lengths.orderBy(F.desc("n"), "d").first()
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"query long, query_id {id_type}, uid long, vec_id {id_type}, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    # written, so that a number names the same row in every job
    rows = written(usable.filter(F.size("v") == common.d).withColumn("uid", F.monotonically_increasing_id()))
    sample = (
        rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id", "v")
        .limit(fit_rows)
        .select("v")
        .toArrow()
    )
    codes = learn(_matrix(sample.column("v")), common.longest, common.n, k, share, seed)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(min(cores, -(-common.n // 256)), -(-common.n // shard_rows))
    blocks = max(1, -(-common.n // (every * query_rows)))
    dealt = F.pmod(F.xxhash64(F.lit(seed + 1), "uid"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(seed + 2), "uid"), F.lit(blocks)).cast("int")

    def everywhere(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select("uid", "id", "v", dealt.alias("shard"), everywhere(blocks).alias("block"))
    queries = rows.filter(F.col("id") % every == 0).select("uid", "id", "v", block.alias("block"), everywhere(shards).alias("shard"))

    names = ["query", "query_id", "uid", "vec_id", "score"]

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in names]
        if left.num_rows and right.num_rows:
            uids, ids, x = left.column("uid").to_numpy(), left.column("id").to_numpy(), _matrix(left.column("v"))
            index = MultiIndex(codes.of(x))
            asked = _matrix(right.column("v"))
            own_ids, own_uids = right.column("id").to_numpy(), right.column("uid").to_numpy()
            for own_id, own, q, code in zip(own_ids, own_uids, asked, codes.of(asked, True), strict=True):
                radius = codes.radius
                found = index.within(code, radius)
                while len(found) <= min(k, len(ids) - 1) and radius < _BITS:
                    radius = min(_BITS, radius + _PARTS)
                    found = index.within(code, radius)
                found = found[uids[found] != own]
                score = (x[found] * q).sum(1)
                if len(found) > k:
                    least = np.partition(score, -k)[-k]
                    some = score >= least
                    found, score = found[some], score[some]
                best = np.lexsort((uids[found], ids[found], -score))[:k]
                rows = found[best]
                n = len(best)
                for column, values in zip(out, (np.full(n, own), np.full(n, own_id), uids[rows], ids[rows], score[best]), strict=True):
                    column.append(values)
        kinds = (np.int64, right.schema.field("id").type.to_pandas_dtype(), np.int64, left.schema.field("id").type.to_pandas_dtype(), float)
        return pa.table([np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, kinds, strict=True)], names)

    found = candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(search, schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
