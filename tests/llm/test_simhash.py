from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from helpers import by_id, table

from loanstrata.llm import simhash
from loanstrata.llm.components import components
from loanstrata.llm.queries import op6_simhash_near_dedup
from loanstrata.llm.simhash import fingerprint, near_duplicates, partitions, similar_links, thresholds


def plain_fingerprint(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    root = {n: n for n in nodes}
    while True:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
        if not changed:
            return root


def test_fingerprint():
    for text in ["", " \n", "A b", "Ä B c D\te\x0bf", "x " * 50, "a\x1cb c d e f g"]:
        assert fingerprint(text, 4) % (1 << 64) == plain_fingerprint(text, 4), text


def test_documents(spark):
    docs = table(spark, "documents")
    prints = {r.doc_id: plain_fingerprint(r.text or "", 4) for r in docs.collect()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    wanted = plain_components(prints, near)
    found = by_id(near_duplicates(docs))
    assert {d: r.component_id for d, r in found.items()} == wanted
    assert {d: r.fp % (1 << 64) for d, r in found.items()} == prints


@pytest.mark.parametrize(("crowd", "distance", "far"), [(1024, 4, 64), (3, 4, 64), (3, 4, 8), (3, 4, 0), (3, 2, 0), (1024, 0, 64), (1024, 6, 64), (3, 6, 4)])
def test_links_against_all_pairs(spark, monkeypatch, crowd, distance, far):
    """Clusters of every tightness, a large one of near copies, and chains; small and crowded values, and
    values that are crowded far more."""
    monkeypatch.setattr(simhash, "_FAR", far)
    rng = random.Random(distance)
    fps = set()
    for size in [1] * 200 + [2, 3, 5, 150]:
        centre = rng.getrandbits(64)
        for _ in range(size):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    low = rng.getrandbits(20)
    fps |= {low | rng.getrandbits(44) << 20 for _ in range(150)}  # equal in a whole part
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    near = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) % (1 << 64)).bit_count() <= distance]
    links = similar_links(spark.createDataFrame([(f,) for f in fps], "fp long"), distance, crowd).collect()
    assert plain_components(fps, [(r.a, r.b) for r in links]) == plain_components(fps, near)


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    links += [(None, 3), (5, 5)]
    nodes = {x for a, b in links if a is not None and a != b for x in (a, b)}
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == plain_components(nodes, [(a, b) for a, b in links if a is not None and a != b])


def test_thresholds():
    cost, chosen = thresholds([[0, 1, 50, 90], [0, 10, 20, 30], [0, 2, 3, 100]], 2)
    assert sum(t + 1 for t in chosen) == 3 and (cost, chosen) == (4.0, [0, -1, 1])


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(0)
    bits = rng.random((500, 64)) < 0.5
    bits[:, 40] = bits[:, 3]
    together = bits.T.astype(float) @ bits
    parts = partitions(together, 500, 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any({3, 40} <= set(p) for p in parts)


def test_query(spark):
    """The registered query: sixteen hex digits, least reachable ids, for every row."""
    docs = {r.doc_id: plain_fingerprint(r.text or "", 4) for r in table(spark, "documents").collect()}
    near = [(a, b) for a in docs for b in docs if a < b and (docs[a] ^ docs[b]).bit_count() <= 4]
    roots = plain_components(docs, near)
    rows = op6_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(d, f"{f:016x}", roots[d]) for d, f in docs.items()}
    assert len(rows) == len(docs)
