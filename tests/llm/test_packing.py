from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
from helpers import SF, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loanstrata.llm import queries as q
from loanstrata.llm.token_output import pack_tokens, plan, write_matrices
from loanstrata.llm.tokens import Encoder


def best_fit_decreasing(lengths, capacity):
    room, bins = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect_left(room, n)
        if k < len(room):
            free = room.pop(k)
        else:
            free, bins = capacity, bins + 1
        if free > n:
            insort(room, free - n)
    return bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=300), st.integers(40, 64))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    counts = Counter(lengths)
    runs = plan(dict(counts), capacity)
    fill = Counter()
    for length in sorted(counts, reverse=True):
        own = [r for r in runs if r[0] == length]
        for rank in range(counts[length]):
            _, first, start, per, offset = [r for r in own if r[1] <= rank][-1]
            behind, within = divmod(rank - first, per)
            assert fill[start + behind] == offset + within * length  # no gap, no overlap
            fill[start + behind] += length
    assert max(fill.values(), default=0) <= capacity
    assert len(fill) == best_fit_decreasing(lengths, capacity)


def test_ids_are_the_library_s():
    reference, encode = Tokenizer.from_file(q.vocabulary()), Encoder(q.vocabulary())
    rng = random.Random(1)
    texts = ["", " ", "a", " a", "a ", "a  b", "a \n b\t c", "it's  we'll I'M", "<|endoftext|>", "x<|endoftext|> y", "é ü 你好 🙂 ",
             " x   y", "1234 5 6!?", "\n\n\n", "a\x1cb \x1f c", " " * 50]
    texts += ["".join(rng.choices("ab \n\té'19.! ", k=rng.randint(0, 60))) for _ in range(500)]
    for text in texts * 2:  # the second time from the memo
        assert np.frombuffer(encode(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, text


def test_round_trip_and_files(spark, tmp_path):
    docs = table(spark, "documents")
    packed = pack_tokens(docs, q.vocabulary(), 256, end_id=0)
    write_matrices(packed, str(tmp_path / "out"), rows_per_file=50)
    parts, rows = {}, spark.read.parquet(str(tmp_path / "out")).collect()
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.length and r.resets == r.cu_seqlens[:-1]
        assert not ids[r.length :].any()
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False)):
            parts.setdefault(r.doc_ids[k], {})[r.starts[k]] = ids[a:b].tolist()
    reference = Tokenizer.from_file(q.vocabulary())
    for r in docs.collect():
        whole = [x for s in sorted(parts[r.doc_id]) for x in parts[r.doc_id][s]]
        assert whole == [*reference.encode(r.text or "", add_special_tokens=False).ids, 0]
    assert len(rows) == len({r.sequence_id for r in rows})


def test_genetic_packing(spark):
    rows = q.op8_best_fit_packing(spark, SF).collect()
    reference = Tokenizer.from_file(q.vocabulary())
    text = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        documents.setdefault(r.doc_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    for doc, own in documents.items():
        ids = [*reference.encode(text[doc] or "", add_special_tokens=False).ids, 0]
        at = 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert documents.keys() == text.keys()
    lengths = [r.length for r in rows]
    assert -(-sum(lengths) // 2048) <= len(sequences) <= best_fit_decreasing(lengths, 2048)


def test_evolution_beats_best_fit(spark):
    """Pairs and triples that only fit together exactly: plain best fit leaves gaps."""
    rng = random.Random(4)
    lengths = []
    for _ in range(60):
        a, b = rng.randint(300, 900), rng.randint(300, 900)
        lengths += [a, b, 2048 - a - b]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "uid long, length long")
    from loanstrata.llm.best_fit_packing import pack

    bins = pack(items, 2048, epochs=2, generations=60, population=6).select("sequence_id").distinct().count()
    assert 60 <= bins < best_fit_decreasing(lengths, 2048)


def test_evolution_with_the_defaults(spark):
    """The budget of the query itself: of 400 exact triples at most three sequences over the bound."""
    rng = random.Random(4)
    lengths = []
    for _ in range(400):
        a, b = rng.randint(300, 900), rng.randint(300, 900)
        lengths += [a, b, 2048 - a - b]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "uid long, length long")
    from loanstrata.llm.best_fit_packing import pack

    bins = pack(items, 2048).select("sequence_id").distinct().count()
    assert 400 <= bins <= 403 < best_fit_decreasing(lengths, 2048)


def test_blocks_exchange_their_emptiest_bins(spark):
    """In blocks of 16 each wastes a part of a bin; what they leave is packed together."""
    from loanstrata.llm.best_fit_packing import pack

    rng = random.Random(2)
    lengths = [rng.randint(200, 1100) for _ in range(400)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "uid long, length long")
    alone, together = (pack(items, 2048, block=16, rounds=r, loose=0.3).collect() for r in (1, 4))
    assert len({r.sequence_id for r in together}) < len({r.sequence_id for r in alone})
    for rows in (alone, together):
        assert sorted((r.uid, r.length) for r in rows) == list(enumerate(lengths))
        bins = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert bins.get(r.sequence_id, 0) == r.offset
            bins[r.sequence_id] = r.offset + r.length
        assert max(bins.values()) <= 2048
