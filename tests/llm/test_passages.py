from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import SF, by_id, documents

from loanstrata.llm import passages
from loanstrata.llm.passages import Windows, slices, word_hashes
from loanstrata.llm.queries import op9_suffix_array_dedup
from loanstrata.llm.suffix_dedup import kept_digests


def plain(texts, words):
    """For each text the number of its windows that another row has, too."""
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    rows = defaultdict(set)
    for i, ws in enumerate(lists):
        for k in range(len(ws) - words + 1):
            rows[tuple(ws[k : k + words])].add(i)
    return [sum(len(rows[tuple(ws[k : k + words])]) > 1 for k in range(len(ws) - words + 1)) for ws in lists]


def test_word_hashes():
    texts = [b"a bc  def\na", b"", b" ", b"\t\x0b x\x85y \xc3\xa4", b"a"]
    for raw in texts:
        start, hashes = word_hashes(raw)
        found = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        assert start.tolist() == found and len(hashes) == len(found)
    _, h = word_hashes(b"ab a ab b a")
    assert h[0] == h[2] and h[1] == h[4] and len(set(h.tolist())) == 3


def test_equal_windows_have_equal_anchors():
    draw = np.random.default_rng(1)
    run = draw.integers(0, 2**63, 70).astype(np.uint64)
    hashes = np.concatenate([draw.integers(0, 2**63, 40).astype(np.uint64), run, draw.integers(0, 2**63, 9).astype(np.uint64), run])
    found = Windows(hashes, np.zeros(len(hashes), int), 51, 16)
    assert len(found.window) == len(hashes) - 50
    first, second = np.arange(40, 60), np.arange(119, 139)
    assert (found.window[first] == found.window[second]).all()
    assert (found.anchor[first] - first == found.anchor[second] - second).all()
    assert len(Windows(hashes[:50], np.zeros(50, int), 51, 16).window) == 0


@pytest.mark.parametrize("most", [200, 1 << 19])
def test_against_all_windows(spark, monkeypatch, most):
    defaults = (16, most)
    monkeypatch.setattr(passages.shared_passages, "__defaults__", defaults)
    rng = random.Random(most)

    def some(n):
        return [rng.choice(["a", "bc", "def", "ä", "xyz"]) for _ in range(n)]

    runs = [some(n) for n in (50, 51, 52, 60, 200)]
    texts = ["", None, " ".join(some(50)), " ".join(some(51))] + ["\n".join(runs[4])] * 2 + ["w" * 900 + " " + " ".join(runs[1])]
    texts += [" ".join(["x"] * 120), "y " * 60, "y " * 51 + "y"]
    for _ in range(40):
        texts.append("  ".join(some(rng.randint(0, 30)) + rng.choice(runs)[rng.choice([0, 0, 1]) :] + some(rng.randint(0, 30))))
    texts += [" ".join(some(30)) + f" alone{i}" for i in range(5)]
    rows = by_id(kept_digests(documents(spark, enumerate(texts)).repartition(4), words=51))
    assert [rows[i].n_shared_passages for i in range(len(texts))] == plain(texts, 51)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = by_id(op9_suffix_array_dedup(spark, SF))
    found = [rows[d.doc_id].n_shared_passages for d in docs]
    assert found == plain([d.text for d in docs], 51) and 0 < sum(n > 0 for n in found) < len(found)


def test_slices_of_long_texts():
    import pyarrow as pa

    text = b" ".join(b"w%d" % i for i in range(500))
    batch = pa.record_batch([pa.array([text], pa.binary())], ["data"])
    found = [(h, o) for _, h, o in slices([batch], 51, 300)]
    _, whole = word_hashes(text)
    windows = set()
    for h, o in found:
        got = Windows(h, o, 51, 16)
        assert windows.isdisjoint(got.window.tolist())
        windows |= set(got.window.tolist())
    assert windows == set(Windows(whole, np.zeros(500, int), 51, 16).window.tolist()) and len(found) > 3
