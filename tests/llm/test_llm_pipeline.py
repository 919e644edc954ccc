from collections import Counter

import corpus_pipeline
from test_llm_decontam import brute as brute_leaks
from test_llm_minhash import bag, overlap
from test_llm_packing import check_layout
from test_llm_unit_dedup import brute as brute_units

from quillstream.llm import minhash, packing, toxicity

DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, DIR).checkpoint()
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, spark.read.parquet(f"{DIR}/labels.parquet")).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, p in scores.items() if not p}

    one = corpus_pipeline.STAGES[1][1](spark, kept, DIR).checkpoint()
    before, after = {r.doc_id: r.text for r in kept.collect()}, {r.doc_id: r.text for r in one.collect()}
    bags = {d: bag(t) for d, t in before.items()}
    for d in before.keys() - after.keys():  # a smaller id of its class stays, and something near it exists
        assert any(before[o] == before[d] or overlap(bags[o], bags[d]) >= minhash.THRESHOLD for o in before if o != d)
    ids = sorted(after)
    for i, a in enumerate(ids):  # no two near texts stay
        assert not any(overlap(bags[a], bags[b]) >= minhash.THRESHOLD for b in ids[:i])

    cut = corpus_pipeline.STAGES[2][1](spark, one, DIR).checkpoint()
    want = brute_units([(d, after[d]) for d in ids])
    assert {r.doc_id: r.text for r in cut.collect()} == {d: t for d, (t, _) in zip(ids, want)}
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = corpus_pipeline.STAGES[3][1](spark, cut, DIR).checkpoint()
    items = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    assert {r.doc_id for r in clean.collect()} == {row[0] for row in brute_leaks(rows, items) if not row[1]}

    packed = corpus_pipeline.STAGES[4][1](spark, clean, DIR).collect()
    check_layout(packed, packing.CAPACITY)
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}


def test_run(spark):
    rows = corpus_pipeline.run(spark, DIR).collect()
    check_layout(rows, packing.CAPACITY)
    assert max(Counter((r.doc_id, r.piece) for r in rows).values()) == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "unit_dedup", "decontaminate", "pack"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.count() == 0
