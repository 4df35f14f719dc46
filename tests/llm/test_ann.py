from __future__ import annotations

import numpy as np
from helpers import table

from loanstrata.llm.ann import MultiIndex, nearest
from loanstrata.llm.queries import op7_ann_search


def test_index_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    codes[:200] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))
    index = MultiIndex(codes)
    for radius in (0, 1, 2, 3, 5, 11, 27, 64):
        for code in codes[::97]:
            assert index.within(code, radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_recall_and_scores(spark):
    vectors = table(spark, "embeddings", "/root/testdata/sf0.1")
    rows = vectors.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    found = {}
    for r in nearest(vectors).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    right = total = 0
    for q, own in found.items():
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        scores = (x * x[ids == q][0]).sum(1)
        assert all(abs(scores[ids == r.vec_id][0] - r.score) < 1e-12 for r in own)
        scores[ids == q] = -np.inf
        right += len({r.vec_id for r in own} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
        total += 20
    assert right >= 0.9 * total


def test_unequal_lengths_and_copies(spark):
    """The largest inner product, not the smallest angle; of many copies the smallest ids."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)) * rng.uniform(0.1, 5, (600, 1))
    x[100:400] = x[100]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in nearest(vectors, every=50, k=5).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    right = 0
    for q, own in found.items():
        scores = (x * x[q]).sum(1)
        scores[q] = -np.inf
        right += len({v for _, v in own} & set(np.lexsort((np.arange(600), -scores))[:5].tolist()))
    assert [v for _, v in sorted(found[200])] == [100, 101, 102, 103, 104] or (x[100] * x[200]).sum() < ((x * x[200]).sum(1)).max()
    assert right >= 0.9 * 5 * len(found)


def test_rows_that_share_an_id(spark):
    """Each is searched and found for itself; only a query's own row isn't its neighbour."""
    rows = [(1, [5.0, 0.0]), (1, [9.0, 0.0]), (20, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [-1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    out = nearest(vectors, every=20, k=4)
    assert dict(out.dtypes)["vec_id"] == "int"
    found = sorted((r["rank"], r.vec_id, r.score) for r in out.collect())
    one = [(1, 1, 9.0), (2, 1, 5.0), (3, 20, 0.0), (4, 3, -1.0)]
    other = [(1, 3, 2.0), (2, 1, 0.0), (3, 1, 0.0), (4, 20, 0.0)]
    assert found == sorted(one + other)


def test_query(spark):
    """The registered query against all pairs: recall, order, exact scores."""
    vectors = table(spark, "embeddings", "/root/testdata/sf0.01").collect()
    ids, x = np.array([r.vec_id for r in vectors]), np.array([r.embedding for r in vectors], np.float64)
    rows = op7_ann_search(spark, "/root/testdata/sf0.01").collect()
    assert {r.query_id for r in rows} == set(ids[ids % 20 == 0].tolist()) and len(rows) == 20 * len(set(ids[ids % 20 == 0]))
    right = 0
    for q in set(ids[ids % 20 == 0].tolist()):
        scores = (x * x[ids == q][0]).sum(1)
        scores[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]].tolist()
        own = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
        assert all(abs(scores[ids == v][0] - s) < 1e-12 for _, v, s in own)
        right += len(set(best) & {v for _, v, _ in own})
    assert right >= 0.9 * len(rows)
