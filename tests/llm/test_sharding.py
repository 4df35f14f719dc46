from __future__ import annotations

import zlib
from collections import Counter

from helpers import by_id, table

from loanstrata.llm.queries import op10_sharding
from loanstrata.llm.sharding import shard


def test_counts_mixture_slots(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    rows = shard(docs, 7).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    per = Counter(r.shard for r in rows)
    assert set(per) == set(range(7)) and max(per.values()) - min(per.values()) <= 1
    for s in range(7):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(per[s]))
    for source, n in Counter(r.source for r in rows).items():
        counts = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(counts[s] - n / 7) < 2 for s in range(7))
    for r in rows:
        assert r.size == len(r.text.encode()) + 16 and r.text_crc32 == zlib.crc32(r.text.encode())


def test_order_by_hand(spark):
    """Two sources of 2 and 4 rows: fractions 1/4, 3/4 and 1/8, 3/8, 5/8, 7/8."""
    rows = [(i, "x", "ab"[i > 1]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = by_id(shard(docs, 1))
    order = "".join(rows[d][2] for d in sorted(out, key=lambda d: out[d].slot))
    assert order == "babbab"


def test_same_result_however_the_rows_lie(spark):
    docs = table(spark, "documents")
    one, two = by_id(shard(docs, 40)), by_id(shard(docs.repartition(9), 40, buckets=4096))
    assert one == two
    assert by_id(shard(docs, 40, seed=1)) != one
    # the width of the ranges changes nothing in the order
    assert by_id(shard(docs, 40, buckets=3)) == one


def test_native(spark):
    plan = shard(table(spark, "documents"), 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_query(spark):
    """The registered query: one law for all rows, sizes, checksums, shards of equal counts, gapless slots."""
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    rows = op10_sharding(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    for r in rows:
        text = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    per = Counter(r.shard for r in rows)
    assert set(per) == set(range(40)) and max(per.values()) - min(per.values()) <= 1
    assert {(r.shard, r.slot) for r in rows} == {(s, k) for s, n in per.items() for k in range(n)}


def test_many_sources_of_one_row(spark):
    """Half of the rows have a source of their own: every shard gets its part of them, no range most."""
    rows = [(i, f"text {i}", f"site{i}" if i % 2 else "large") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for spread in (False, True):
        out = shard(docs, 10, spread=spread).collect()
        assert sorted(Counter(r.shard for r in out).values()) == [400] * 10
        own = Counter(r.shard for r in out if r.doc_id % 2)
        if spread:
            assert max(own.values()) < 260 and min(own[s] for s in range(10)) > 140
        else:
            assert max(own.values()) == 400  # all at the fraction one half
