from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from helpers import CLASHES

from loanstrata.llm import centroid_clustering
from loanstrata.llm.centroid_clustering import cluster, nearest
from loanstrata.llm.queries import op13_centroid_clustering

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, k, rounds, seed, scale=256):
    """[(vec_id, cluster, distance, cluster_inertia, inertia, sha)], a vector at a time."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in vectors]

    def first(row):
        number = "" if row[0] is None else row[0]
        return hashlib.sha256(f"{seed}:{number}".encode()).hexdigest(), np.array(row[1], "<i4").tobytes()

    centroids = [v for _, v in sorted(kept, key=first)[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(column) // len(vs) for column in zip(*vs, strict=True)]
    found = [(i, *best(v)) for i, v in kept]
    sums = {n: sum(d for _, d, m in found if m == n) for _, _, n in found}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, sums[n], sum(sums.values()), sha[n]) for i, d, n in found), key=repr)


def vectors(n, dims, spread, seed):
    draw = random.Random(seed)
    rows = [(i, [draw.gauss(0, spread) for _ in range(dims)]) for i in range(n)]
    # repeated vectors, repeated ids, a null id
    return rows + [(n + i, v) for i, v in rows[:9]] + [(i, rows[9][1]) for i, _ in rows[:9]] + [(None, rows[0][1])]


@pytest.mark.parametrize(("spread", "k"), [(0.2, 7), (0.005, 20), (5000.0, 5)])
def test_against_plain_python(spark, monkeypatch, spread, k):
    monkeypatch.setattr(centroid_clustering, "SLICE", 50)
    rows = vectors(150, 6, spread, k)
    out = cluster(spark.createDataFrame(rows, SCHEMA).repartition(4), k=k, rounds=3, dims=6)
    assert sorted(map(tuple, out.collect()), key=repr) == plain(rows, k, 3, 2)


def test_same_result_however_the_rows_lie(spark):
    rows = vectors(200, 4, 0.1, 1)
    one = cluster(spark.createDataFrame(rows, SCHEMA).coalesce(1), k=9, dims=4)
    two = cluster(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), k=9, dims=4)
    assert sorted(one.collect(), key=repr) == sorted(two.collect(), key=repr)


def test_ties_and_empty_clusters(spark):
    # three equal vectors start three centroids: the first takes all, the others stay empty where they are
    rows = [(i, [0.5, -0.001]) for i in range(3)]
    out = cluster(spark.createDataFrame(rows, SCHEMA), k=3, dims=2).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in out} == {(0, 0, 0)}
    assert {r.centroid_sha256 for r in out} == {hashlib.sha256(b"128,-1").hexdigest()}


def test_edges(spark):
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-3.0, 0.1]), (None, [0.0, 0.0])]
    bad = [None, [], [1.0], [1.0, 2.0, 3.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, -float("inf")]]
    rows = [(*r, *["clash"] * (len(CLASHES) + 2)) for r in [*good, *[(50 + i, v) for i, v in enumerate(bad)]]]
    schema = SCHEMA + ", " + ", ".join(f"{c} string" for c in [*CLASHES, "cluster", "distance"])
    given = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, cluster(given, k=40, dims=2).collect()), key=repr) == plain(good, 40, 5, 2)
    for none in (given.limit(0), given.filter("vec_id >= 50")):
        out = cluster(none, dims=2)
        assert out.collect() == [] and "centroid_sha256" in out.columns


def test_huge_components_are_clamped(spark):
    rows = [(1, [3e38, -3e38]), (2, [0.0, 0.0])]
    out = {r.vec_id: r for r in cluster(spark.createDataFrame(rows, SCHEMA), k=1, rounds=0, dims=2).collect()}
    assert sorted(r.distance for r in out.values())[0] == 0
    assert 0 < max(r.distance for r in out.values()) < 2**63
    assert all(r.inertia == max(q.distance for q in out.values()) for r in out.values())


def test_distances_from_tables():
    draw = np.random.default_rng(3)
    for high in (5, 300, 10**6):
        values = draw.integers(-high, high, (500, 8)).astype(np.int32)
        centroids = draw.integers(-high, high, (11, 8))
        distances = ((values[:, None].astype(np.int64) - centroids[None]) ** 2).sum(axis=2)
        found, least = nearest(values, centroids)
        assert (found == distances.argmin(axis=1)).all() and (least == distances.min(axis=1)).all()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = op13_centroid_clustering(spark, sf).collect()
    assert sorted(map(tuple, out), key=repr) == plain(rows, 40, 5, 2)
