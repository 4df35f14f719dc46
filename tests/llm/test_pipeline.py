"""Every stage against a brute-force version on its own input."""

from __future__ import annotations

import corpus_pipeline
from helpers import SF, table
from oracle import connect
from test_packing import best_fit_decreasing
from test_simhash import plain_components, plain_fingerprint

from loanstrata.llm.common import written
from loanstrata.llm.oracle import LLM_ORACLE


def keyed(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark):
    docs = written(table(spark, "documents"))
    inputs, outputs = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = outputs[name] = written(stage(spark, docs, SF))
    before, after = keyed(inputs["language ID"]), keyed(outputs["language ID"])
    assert all(before[d] == r for d, r in after.items())
    assert len(after) >= 0.99 * len(before)  # clean documents stay
    assert all(any(c.isalpha() for c in r.text) for r in after.values())

    con = connect(SF)
    con.register("given", inputs["line dedup"].toPandas())
    sql = LLM_ORACLE["op4_line_dedup"].replace("FROM documents", "FROM given")
    wanted = {r[0]: r[1] for r in con.sql(sql).fetchall()}
    after = keyed(outputs["line dedup"])
    assert {d: r.text for d, r in after.items()} == wanted
    assert all(r.n_chars == len(r.text) for r in after.values())

    before, after = keyed(inputs["SimHash near-dedup"]), keyed(outputs["SimHash near-dedup"])
    prints = {d: plain_fingerprint(r.text, 4) for d, r in before.items()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    assert after == {d: before[d] for d, root in plain_components(prints, near).items() if d == root}

    before, after = keyed(inputs["benchmark decontamination"]), keyed(outputs["benchmark decontamination"])
    items = [" ".join(r.text.lower().split()) for r in table(spark, "benchmark").collect()]
    clean = {d for d, r in before.items() if not any(t in " ".join(r.text.lower().split()) for t in items)}
    assert set(after) == clean and all(before[d] == r for d, r in after.items())

    rows = outputs["best-fit packing"].collect()
    assert {r.doc_id for r in rows} == set(after)
    lengths = [r.length for r in rows]
    assert len({r.sequence_id for r in rows}) <= best_fit_decreasing(lengths, 2048)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_near_dedup_when_scans_are_cut_anew(spark, tmp_path, monkeypatch):
    """Executors come and go between jobs, and the scan of the documents is cut otherwise: the same rows go."""
    table(spark, "documents").repartition(8, "doc_id").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    wanted = sorted(corpus_pipeline.simhash_near_dedup(spark, docs, SF).collect())
    found = corpus_pipeline.near_duplicates

    def cut_anew(*args, **kwargs):
        out = found(*args, **kwargs)
        spark.conf.set("spark.sql.files.minPartitionNum", "64")
        return out

    monkeypatch.setattr(corpus_pipeline, "near_duplicates", cut_anew)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert sorted(corpus_pipeline.simhash_near_dedup(spark, docs, SF).collect()) == wanted
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
