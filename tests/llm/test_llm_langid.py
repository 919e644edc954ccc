import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillstream.llm import langid
from quillstream.llm.textarrays import LETTER, blocks, char_classes

DIR = "/root/testdata/sf0.01"
TEXTS = ["Plain words, a few.", "", None, "12 -- 34", "Été à l'école", "日本語 テキスト", "a", "x " * 4000, "ÀÉ a b"]


def plain_profile(text):
    """Grams letter by letter, bound and added one at a time."""
    shown = [c if char_classes()[ord(c)] == LETTER else " " for c in (text or "").lower()]
    padded = [" ", *shown, " "]
    vector = lambda c, turn: np.roll(langid.letter_vectors(np.array([ord(c)]))[0].astype(int), turn)
    out = np.zeros(langid.DIM, dtype=int)
    for i in range(1, len(padded) - 1):
        if padded[i] != " ":
            out += vector(padded[i - 1], 2) * vector(padded[i], 1) * vector(padded[i + 1], 0)
    return out


@pytest.mark.parametrize("cells, grams", [(1 << 23, 4096), (8, 3)])
def test_profiles_are_bound_and_bundled(monkeypatch, cells, grams):
    monkeypatch.setattr(langid, "CELLS", cells)
    monkeypatch.setattr(langid, "GRAMS_AT_ONCE", grams)
    for limit in (1 << 20, 1):
        got = np.concatenate([langid.profiles(b) for b in blocks(pa.array(TEXTS), lower=True, limit=limit)])
        assert (got == np.array([plain_profile(t) for t in TEXTS])).all()


def test_letter_vectors_are_nearly_orthogonal():
    signs = langid.letter_vectors(np.arange(97, 123)).astype(int)
    likeness = signs @ signs.T / langid.DIM
    assert (np.diag(likeness) == 1).all() and np.abs(likeness - np.eye(26)).max() < 0.2


def test_prototypes_and_predictions_equal_a_plain_version(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], ["en", "fr", None][i % 3]) for i in range(40)] + [(None, "abc", "xx"), (41, "abc abd", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs.repartition(5)).collect()
    sums = {}
    for i, text, lang in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5 and lang is not None and text is not None:
            vector = plain_profile(text)
            sums[lang] = sums.get(lang, 0) + np.rint(vector / max(np.linalg.norm(vector), 1e-9) * langid.SCALE)
    langs = sorted(k for k, v in sums.items() if np.any(v))
    want = {}
    for i, text, _ in rows:
        vector = plain_profile(text)
        near = [vector @ sums[k] / max(np.linalg.norm(vector) * np.linalg.norm(sums[k]), 1e-9) for k in langs]
        want[i] = (langs[int(np.argmax(near))], min(1, max(0, max(near)))) if vector.any() else ("und", 0)
    assert len(got) == len(rows) and "xx" not in langs
    for r in got:
        assert r.lang_pred == want[r.doc_id][0] and r.score == pytest.approx(want[r.doc_id][1])
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_defined_cases(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    docs = spark.createDataFrame([(1, "a b", None, "x", 1), (1, "a b", None, "x", 1), (2, None, "en", "", 2), (5, "", "en", "", 0)], schema)
    assert [(r.lang_pred, r.score) for r in langid.identify(docs).collect()] == [("und", 0.0)] * 4  # nothing to learn
    assert langid.identify(docs.limit(0)).count() == 0
    scored = langid.predict(docs, (["en"], np.ones((1, langid.DIM))))
    assert scored.columns == ["doc_id", "text", "lang", "lang_pred", "score"]


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where(F.col("held_out")).collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
