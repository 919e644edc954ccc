import zlib

import numpy as np
import pyarrow as pa
import pytest

from quillstream.llm import quality
from quillstream.llm.textarrays import blocks

DIR = "/root/testdata/sf0.01"
TEXTS = ["Plain words, a few of them.", "", None, "SHOUT!! SHOUT!! SHOUT!!", "a a a a a a a", "x | y | z\nx | y | z", "été 12 34", "w " * 5000]


def rows_of(texts, limit=1 << 20):
    return [quality.feature_rows(b) for b in blocks(pa.array(texts, pa.string()), limit=limit)]


def test_margins_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=quality.N_FEATURES), rng.normal(size=(quality.N_FEATURES, 3)))
    (rows,) = rows_of(TEXTS)
    got = machine.margins(rows, len(TEXTS))
    for i in range(len(TEXTS)):
        f, x = rows.feature[rows.owner == i], rows.value[rows.owner == i]
        pairs = sum(machine.factors[f[a]] @ machine.factors[f[b]] * x[a] * x[b] for a in range(len(f)) for b in range(a))
        assert got[i] == pytest.approx(0.3 + machine.linear[f] @ x + pairs)


def test_features_do_not_depend_on_the_block():
    whole, parts = rows_of(TEXTS)[0], rows_of(TEXTS, limit=1)
    assert len(parts) > 1
    assert (np.concatenate([p.feature for p in parts]) == whole.feature).all()
    assert np.allclose(np.concatenate([p.value for p in parts]), whole.value)


def test_structure_bands():
    (block,) = blocks(pa.array(TEXTS, pa.string()))
    from quillstream.llm.textarrays import span_hashes, word_spans

    start, end, owner = word_spans(block)
    bands = quality.structure(block, owner, span_hashes(block.codes, start, end))
    named = dict(zip(quality.SHARES + quality.SIZES, bands.T))
    assert named["capitals"][3] == quality.BANDS - 1 and named["capitals"][4] == 0
    assert named["repeated neighbours"][4] > named["repeated neighbours"][3] > named["repeated neighbours"][0] == 0
    assert named["doubled signs"][3] > 0 and named["bars"][5] > 0 and named["digits"][6] > 0
    assert (bands[1] == bands[2]).all() and bands.max() < quality.BANDS


def test_training_learns_an_interaction():
    """Labels are the exclusive or of two words: no linear rule tells them."""
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (800, 2))
    texts = [" ".join(["alpha"] * a + ["beta"] * b + ["and"]) for a, b in bits]
    (rows,) = rows_of(texts)
    keep = rows.feature < quality.BUCKETS
    rows = quality.Rows(rows.owner[keep], rows.feature[keep], np.ones(keep.sum()))
    label = (bits[:, 0] ^ bits[:, 1]).astype(float)
    machine = quality.train(rows, label, epochs=40, ridge=1e-5)
    assert ((machine.margins(rows, len(texts)) > 0) == (label > 0)).mean() > 0.95


def test_defined_cases(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b", 2), (None, None, 3), (1, "a b", 2)], "doc_id long, text string, score int")
    got = quality.score_documents(docs, labels).collect()
    assert [r.score for r in got] == [quality.PRIOR] * 3 and [r.doc_id for r in got] == [1, None, 1]
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score_documents(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in held for b in held if a.quality and not b.quality]
    assert np.mean(pairs) > 0.95
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
