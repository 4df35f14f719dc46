"""Clustering of integer vectors around centroids; distances are read from tables of squared differences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.llm.common import written

#: Vectors whose distances to all centroids a task holds at a time.
SLICE = 4096
_MOST = 2**63 - 1


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
    dims: int = 64,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Cluster of every vector of ``dims`` finite components:
    (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    A component x counts as the integer floor(scale * x). The first centroids are the ``k`` vectors of
    the smallest sha256 of ``<seed>:<id>``, in that order. A round gives each vector to its nearest
    centroid (squared distance, ties to the smaller number) and moves a centroid to the floor of its
    vectors' mean; one without vectors stays. All arithmetic is on integers, so neither the order of rows
    nor that of tasks changes a result.

    A round is one pass over the vectors, which are written once as 32-bit integers. A task hands on at
    most ``k`` sums, however many vectors a cluster has; the driver holds ``k`` centroids.

    Vectors that are null, have another length, or hold a null, NaN or infinite component are left out.
    Rows of equal ids are vectors of their own; where they compete for the last first centroid, their
    bytes decide. A null id is hashed as an empty one. Fewer than ``k`` vectors give as many centroids,
    none gives no rows. Integers are clamped to where ``dims`` squared differences fit a long (beyond
    2 ** 27 for 64 dimensions), and sums of distances end at the largest long.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    kept = written(_integers(vectors, dims, scale, id_col, vector_col, id_type))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.select("v", digest.alias("h")).orderBy("h", "v").limit(k).collect()
    schema = (
        f"{id_col} {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([np.frombuffer(r.v, "<i4") for r in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(kept, centroids)

    def assign(batches):
        for batch in batches:
            for part, values in _slices(batch, dims):
                yield pa.RecordBatch.from_arrays([part.column("id"), *map(pa.array, nearest(values, centroids))], names)

    names = ["id", "cluster", "distance"]
    assigned = written(kept.mapInArrow(assign, f"id {id_type}, cluster int, distance long"))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(exact.alias("s")).collect()}
    total = min(sum(inertia.values()), _MOST)
    found = [
        (c, min(s, _MOST), total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, s in inertia.items()
    ]
    # one row per centroid
    per_cluster = spark.createDataFrame(found, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (
        assigned.withColumnRenamed("id", id_col)
        .join(F.broadcast(per_cluster), "cluster")
        .select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )


def _integers(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str, id_type: str) -> DataFrame:
    """(id, v): the vectors taken, as little-endian 32-bit integers."""
    most = min(isqrt(_MOST // dims) // 2, 2**31 - 1)

    def quantise(batches):
        for batch in batches:
            values = pc.list_flatten(batch.column("x")).to_numpy(zero_copy_only=False).astype(np.float64)
            integers = np.clip(np.floor(scale * values), -most, most).astype("<i4")
            blob = pa.py_buffer(integers.tobytes())
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * dims), batch.num_rows, [None, blob])
            yield pa.RecordBatch.from_arrays([batch.column("id"), fixed.cast(pa.binary())], ["id", "v"])

    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    taken = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    return taken.filter((F.size(x) == dims) & finite).mapInArrow(quantise, f"id {id_type}, v binary")


def _slices(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        fixed = part.column("v").cast(pa.binary(4 * dims))
        whole = np.frombuffer(fixed.buffers()[1], "<i4").reshape(-1, dims)
        yield part, whole[fixed.offset : fixed.offset + len(fixed)]


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, the smaller number at ties, and the squared distance.

    Each dimension has a table with a row per integer that occurs and a column per centroid; a row's
    distances are the sum of its integers' table rows.
    """
    distances = np.zeros((len(values), len(centroids)), np.int64)
    for d in range(values.shape[1]):
        occurring, at = _occurring(values[:, d])
        table = (occurring[:, None] - centroids[None, :, d]) ** 2
        distances += table.take(at, axis=0)
    cluster = distances.argmin(axis=1)
    return cluster.astype(np.int32), distances[np.arange(len(values)), cluster]


def _occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers of a column in ascending order, and the place of each row's integer among them."""
    low = int(column.min())
    if int(column.max()) - low > 8 * SLICE:
        occurring, at = np.unique(column, return_inverse=True)
        return occurring.astype(np.int64), at
    shifted = column - np.int32(low)
    seen = np.bincount(shifted) > 0
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[shifted]


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dims = centroids.shape

    def sums(batches):
        total, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, values in _slices(batch, dims):
                cluster, _ = nearest(values, centroids)
                order = np.argsort(cluster, kind="stable")
                found, starts, n = np.unique(cluster[order], return_index=True, return_counts=True)
                total[found] += np.add.reduceat(values[order].astype(np.int64), starts, axis=0)
                counts[found] += n
        for c in np.flatnonzero(counts).tolist():
            columns = [pa.array([c], pa.int32()), pa.array([counts[c]], pa.int64()), pa.array([total[c].tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "s"])

    parts = kept.select("v").mapInArrow(sums, "cluster int, n long, s array<long>")
    added = (
        parts.select("cluster", "n", F.posexplode("s").alias("dim", "s"))
        .groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    )
    moved = centroids.copy()
    for r in added.collect():
        moved[r.cluster, r.dim] = int(r.s) // r.n
    return moved
