from __future__ import annotations

import hashlib
import re

import pytest
from helpers import ROWS, SF, documents, edge_documents, table

from loanstrata.llm.fill_in_middle import fill_in_middle, restored
from loanstrata.llm.queries import op12_fill_in_middle

TEXTS = ["a", "\n", "\n\n\n", "a\n", "a\nb", "\na\n\nb\n", "a\r\nb\x0b\x85\u2028c\n", "ä\n€\n𝄞", "<P", "<", "S>\n<", "x<P>y\nz", "<S>", "a\n<M>"]


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs, pairs, **given):
    out = restored(fill_in_middle(docs, **given)).collect()
    made = sorted((tuple(r)[:6] for r in out), key=repr)
    assert made == sorted(((i, *plain(i, t, **given)) for i, t in pairs), key=repr)
    assert sorted(((r.doc_id, r.restored) for r in out), key=repr) == sorted(((i, t or "") for i, t in pairs), key=repr)
    return out


@pytest.mark.parametrize("given", [{}, {"rate": 50, "spm": 20, "seed": 3}, {"rate": 0}, {"spm": 100}])
def test_against_plain_python(spark, given):
    pairs = [(i, TEXTS[i % len(TEXTS)]) for i in range(40 * len(TEXTS))]
    out = check(documents(spark, pairs), pairs, **given)
    if not given:
        assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_edges(spark):
    docs = edge_documents(spark)
    check(docs, [(r[0], r[1]) for r in ROWS])
    assert restored(fill_in_middle(docs.limit(0))).collect() == []


def test_other_ids_and_marks(spark):
    docs = spark.createDataFrame([("x", "a\nb\nc<P>", 0), (None, None, 1)], "name string, body string, h1 int")
    out = {r.doc_id: r for r in fill_in_middle(docs, marks=("<a>", "<bb>", "<c c>"), id_col="name", text_col="body").collect()}
    assert out["x"].form != "plain" and "<bb>" in out["x"].output
    assert (out[None].form, out[None].output) == ("plain", "")
    for marks in (("<a>", "<a>", "<b>"), ("a", "<b>", "<c>"), ("<a>", "<b<c>", "<d>")):
        with pytest.raises(ValueError, match="marks"):
            fill_in_middle(docs, marks=marks, id_col="name", text_col="body")


def test_query(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = set()
    for r in table(spark, "documents").select("doc_id", "text").collect():
        *columns, output = plain(r.doc_id, r.text)
        expected.add((r.doc_id, *columns, sha(output), sha(r.text or "")))
    rows = op12_fill_in_middle(spark, SF).collect()
    assert len(rows) == len(expected) and {tuple(r) for r in rows} == expected


def test_no_shuffle(spark):
    plan = op12_fill_in_middle(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
