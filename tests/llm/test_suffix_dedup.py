from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import SF, by_id, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from loanstrata.llm import suffix_dedup
from loanstrata.llm.queries import op9_suffix_array_dedup
from loanstrata.llm.suffix_dedup import LoserTree, _decode, _encode, kept_digests


def plain(texts, length):
    windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(rows):
    return {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in rows.items()}


@pytest.mark.parametrize(("crowd", "segment"), [(1024, 1 << 20), (40, 1 << 20), (3, 1 << 20), (3, 300)])
def test_against_all_windows(spark, monkeypatch, crowd, segment):
    """Copies, near copies, passages with other text around them, repeats in one text, overlaps."""
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", segment)
    rng = random.Random(crowd)

    def some(n):
        return "".join(rng.choices("abcdefgh é", k=n))

    passages = [some(n) for n in (63, 64, 70, 95, 130, 200, 900)]
    texts = ["", "a" * 63, "a" * 64, "a" * 65, "ab" * 100, some(500)]
    texts += [texts[-1]] * 3 + [texts[-1][:250], texts[-1][100:] + "z"]
    base = some(700)
    for _ in range(30):
        near = list(base)
        for _ in range(rng.randint(1, 6)):
            near[rng.randrange(len(near))] = "#"
        texts.append("".join(near))
    for _ in range(60):
        texts.append("".join(some(rng.randint(0, 80)) + rng.choice(passages)[rng.choice([0, 0, 5]) :] for _ in range(rng.randint(1, 3))))
    rows = by_id(kept_digests(documents(spark, enumerate(texts)).repartition(5), 64, crowd))
    assert result(rows) == dict(enumerate(plain([t.encode() for t in texts], 64)))


@pytest.mark.parametrize("length", [32, 33, 100])
def test_other_lengths(spark, length):
    rng = random.Random(length)
    parts = ["".join(rng.choices("abcdefgh ", k=n)) for n in (31, 32, 40, 99, 100, 150)]
    texts = ["".join(rng.choice(parts)[rng.randint(0, 9) :] for _ in range(rng.randint(0, 4))) for _ in range(60)]
    rows = by_id(kept_digests(documents(spark, enumerate(texts)), length))
    assert result(rows) == dict(enumerate(plain([t.encode() for t in texts], length)))


def test_documents(spark):
    rows = by_id(op9_suffix_array_dedup(spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    wanted = plain([(r.text or "").encode() for r in docs], 400)
    assert result(rows) == {r.doc_id: w for r, w in zip(docs, wanted, strict=True)}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=12), max_size=12), max_size=7))
def test_loser_tree(runs):
    runs = [sorted((s.encode(), b"L", 1, 2, 3, 4, 5) for s in run) for run in runs]
    merged = list(LoserTree([_decode(*_encode(run)) for run in runs if run])) if any(runs) else []
    strings = [m[1] for m in merged]
    assert strings == sorted(i[0] for run in runs for i in run)
    before = b""
    for common, string, left, numbers in merged:
        n = next((k for k, (p, q) in enumerate(zip(before, string, strict=False)) if p != q), min(len(before), len(string)))
        assert common == n and left == b"L" and tuple(numbers) == (1, 2, 3, 4, 5)
        before = string
