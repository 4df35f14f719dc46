from __future__ import annotations

import hashlib
import random

import pytest
from helpers import CLASHES, LONG, SF

from loanstrata.llm.chat_formatting import TRAINED, format_conversations, read_back, render, turns, unescape
from loanstrata.llm.queries import CONTROL_TEXT, op11_chat_formatting

LOG = "conv_id long, seq long, kind string, message_id string, role string, text string"
TEXTS = ["", "a", "\\", "\\\\n", "###", "####", "</turn>", "\\</turn>\n", "<</turn>>\n### user\n", CONTROL_TEXT, "ä€𝄞\n"]


def key(event):
    return [(v is not None, v) for v in event]


def plain_fold(log):
    """conv_id -> [(role, text)], event by event."""
    found = {}
    for n, (conv, _, kind, message, role, text) in enumerate(sorted(log, key=key)):
        messages = found.setdefault(conv, {})
        m = messages.setdefault(n if message is None else message, {"role": None, "text": "", "open": True, "gone": False})
        if kind == "delta":
            m["text"] += (text or "") if m["open"] else ""
        else:
            m.update(text=text or "", open=kind not in ("edit", "delete"), gone=kind == "delete")
        m["role"] = m["role"] if role is None else role
    return {c: [(m["role"] or "", m["text"]) for m in ms.values() if not m["gone"]] for c, ms in found.items()}


def digest(chosen):
    rendered = "".join(render(r, t)[0] for r, t in chosen)
    loss = "".join(t for r, t in chosen if r == TRAINED)
    return (
        len(chosen),
        hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in chosen).encode()).hexdigest(),
        len(loss),
        hashlib.sha256(loss.encode()).hexdigest(),
        len(rendered),
    )


@pytest.mark.parametrize("text", TEXTS)
def test_a_turn_comes_back(text):
    formatted = "".join(render(r, text)[0] for r in ("user", text, "assistant"))
    assert list(turns(formatted)) == [("user", text), (text, text), ("assistant", text)]
    turn, start, end = render("assistant", text)
    assert unescape(turn[start:end]) == text


def random_log(n, seed):
    """A third of the events belong to one conversation; streams, edits and regenerations mix."""
    draw = random.Random(seed)
    kinds = ["message", "delta", "delta", "delta", "edit", "regenerate", "delete", None]
    return [
        (
            draw.choice([1, 1, 1, 1, 2, 3, 4, 5, 6, None]),
            draw.choice([None, *range(n // 3)]),
            draw.choice(kinds),
            draw.choice([None, *"abcdefgh"]),
            draw.choice([None, "user", TRAINED, "a\nb"]),
            draw.choice([None, *TEXTS]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("part_chars", [1, 300, 4_000_000])
def test_against_an_event_by_event_fold(spark, part_chars):
    log = random_log(600, part_chars)
    log += log[:50]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = format_conversations(spark.createDataFrame(log, LOG).repartition(5), part_chars)
        rows = parts.collect()
        out = {r.conv_id: tuple(r)[1:] for r in read_back(parts).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = plain_fold(log)
    assert out == {c: digest(chosen) for c, chosen in expected.items()}
    for conv, chosen in expected.items():
        mine = sorted((r for r in rows if r.conv_id == conv), key=lambda r: key((r.seq, r.nth)))
        assert [t for r in mine for t in turns(r.formatted)] == chosen
        masked = [unescape(r.formatted[a:b]) for r in mine for a, b in zip(r.loss_starts, r.loss_ends, strict=True)]
        assert masked == [t for r, t in chosen if r == TRAINED]
    if part_chars < 1000:
        # the large conversation is many tasks' work
        assert sum(r.conv_id == 1 for r in rows) > 5


def test_fold_by_hand(spark):
    log = [
        (1, 0, "message", "q", "user", "Hi"),
        (1, 1, "delta", "a", "assistant", "He"),
        (1, 2, "delta", "a", None, "llo"),
        (1, 3, "message", "q2", "user", "More"),
        (1, 4, "regenerate", "a", None, None),
        (1, 5, "delta", "a", None, "Good day"),
        (1, 6, "edit", "q2", None, "More, please"),
        (1, 7, "delta", "q2", None, " (late)"),
        (1, 8, "message", "x", "user", "oops"),
        (1, 9, "delete", "x", None, None),
        (2, 0, "message", "x", "user", "gone"),
        (2, 1, "delete", "x", None, None),
    ]
    parts = {r.conv_id: r for r in format_conversations(spark.createDataFrame(log, LOG)).collect()}
    assert list(turns(parts[1].formatted)) == [("user", "Hi"), ("assistant", "Good day"), ("user", "More, please")]
    assert parts[1].formatted.startswith("### user\nHi</turn>\n### assistant\nGood day</turn>\n")
    assert (parts[2].n_turns, parts[2].formatted) == (0, "")


def test_edges(spark):
    log = [(1, 0, "message", None, "user", LONG), (1, 1, "message", None, "assistant", LONG), (None, None, None, None, None, None)]
    schema = LOG + ", " + ", ".join(f"{c} string" for c in [*CLASHES, "whole", "n_turns", "formatted", "nth", "message"])
    wide = spark.createDataFrame([(*e, *["clash"] * (len(CLASHES) + 5)) for e in log * 2], schema)
    out = {r.conv_id: tuple(r)[1:] for r in read_back(format_conversations(wide)).collect()}
    assert out == {c: digest(chosen) for c, chosen in plain_fold(log * 2).items()}
    assert read_back(format_conversations(wide.limit(0))).collect() == []


def test_query(spark):
    rows = {r.conv_id: tuple(r)[1:] for r in op11_chat_formatting(spark, SF).collect()}
    given = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    log = [(r.conv_id, r.turn, "message", None, r.role, r.text) for r in given]
    log += [(-7, 0, "message", None, "user", CONTROL_TEXT), (-7, 1, "message", None, "assistant", CONTROL_TEXT)]
    assert rows == {c: digest(chosen) for c, chosen in plain_fold(log).items()}
