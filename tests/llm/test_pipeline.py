"""The pipeline's stages against brute-force versions, one after the other."""

from __future__ import annotations

import corpus_pipeline
from test_decontaminate import brute_shares
from test_near_dup import brute
from test_packing import check, tokenizer
from test_pii import added, plain
from test_quality_rules import counts

from contrail.llm import pii
from contrail.llm.common import stage
from contrail.llm.near_dup import WORD_PERCENT
from contrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "packing"]

    docs = stage(functions["quality_rules"](spark, docs, SMALL), "t")
    verdicts = {r.doc_id: r.kept for r in QUERIES["op3_mcd_quality_rules"](spark, SMALL).collect()}
    now = {r.doc_id: r for r in docs.collect()}
    assert set(now) == {i for i, ok in verdicts.items() if ok} and docs.columns == columns
    assert not any(counts(r.text)[-1] for r in now.values())
    assert all(now[i] == rows[i] for i in now)

    docs = stage(functions["near_duplicates"](spark, docs, SMALL), "t")
    want = {i for i, (_, top) in brute([(i, r.text) for i, r in now.items()], WORD_PERCENT).items() if i == top}
    now = {r.doc_id: r for r in docs.collect()}
    assert set(now) == want and docs.columns == columns and docs.count() == len(want)

    docs = stage(functions["decontamination"](spark, docs, SMALL), "t")
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    share = {i: max(brute_shares(r.text, t) for t in items) for i, r in now.items()}
    left = {r.doc_id: r for r in docs.collect()}
    assert {i for i, s in share.items() if s < 0.6} <= set(left) <= {i for i, s in share.items() if s < 0.85}

    docs = stage(functions["personal_data"](spark, docs, SMALL), "t")
    clean = {r.doc_id: r for r in docs.collect()}
    assert set(clean) == set(left) and docs.columns == columns
    for i, r in clean.items():
        assert r.text == pii.redacted(left[i].text, plain(left[i].text) + added(left[i].text))
        assert r.n_chars == len(r.text) if r.text != left[i].text else r == left[i]

    pieces = [r.asDict() for r in functions["packing"](spark, docs, SMALL).collect()]
    check(pieces, {i: r.text for i, r in clean.items()}, tokenizer())
    assert all(len(p["ids"]) == p["length"] for p in pieces)


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and {"doc_id", "ids", "sequence_id", "offset"} <= set(out.columns)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, fn in corpus_pipeline.STAGES:
        docs = stage(fn(spark, docs, SMALL), f"t-{name}")
    assert docs.count() == 0
