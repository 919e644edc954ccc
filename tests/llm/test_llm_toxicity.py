import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstream.llm import toxicity
from quillstream.llm.textarrays import blocks

DIR = "/root/testdata/sf0.01"
WORDS = "idiot moron stupid clown loser trash pathetic worthless disgusting scum the and station in of it is".split()


def model_of(texts):
    counts = sum(toxicity.trigram_counts(b) for b in blocks(pa.array(texts), lower=True))
    return toxicity.log_model(counts.astype(float))


def symbols(word):
    codes = toxicity.letter_codes()
    return [int(codes[ord(c)]) for c in word]


def test_trigrams_are_those_of_the_words():
    texts = ["It is; été 12a b", "", "x"]
    want = Counter()
    for text in texts:
        stream = [toxicity.EDGE]
        for word in "".join(c if toxicity.letter_codes()[ord(c)] != 255 else " " for c in text.lower()).split():
            stream += [*symbols(word), toxicity.EDGE]
        want.update(zip(stream, stream[1:], stream[2:]))
    for limit in (1, 100):
        got = Counter()
        for b in blocks(pa.array(texts), lower=True, limit=limit):
            k = toxicity.trigram_counts(b)
            for i in np.flatnonzero(k).tolist():
                got[i // 784, i // 28 % 28, i % 28] += int(k[i])
        e = toxicity.EDGE
        inner = lambda c: Counter({k: v for k, v in c.items() if k[1] != e})
        assert inner(got) == inner(want)


def brute(form, model):
    """Every path of the lattice, scored like the search."""
    best = None
    for path in itertools.product(*toxicity.lattice(form), [(" ", 0.0)]):
        x = y = toxicity.EDGE
        cost, text = 0.0, ""
        for letters, extra in path:
            cost += extra
            for c in letters:
                if c == " ":
                    if y == toxicity.EDGE:
                        continue
                    cost -= model[x][y][toxicity.EDGE]
                    x = y = toxicity.EDGE
                else:
                    s = symbols(c)[0]
                    cost -= model[x][y][s if s != 255 else toxicity.ELSE]
                    x, y = y, s
                text += c
        if best is None or (round(cost, 9), text) < best:
            best = (round(cost, 9), text)
    return best


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("idiot10@.!*é"), min_size=1, max_size=7))
def test_search_finds_the_best_path(form):
    model = model_of([" ".join(WORDS)])
    words = toxicity.Restorer(model).search(form)
    assert words == brute(form, model)[1].split()


def test_restores_disguised_words():
    restore = toxicity.Restorer(model_of([" ".join(WORDS * 5)]))
    for form, word in {
        "1d10t": "idiot", "m0r0n": "moron", "tr@sh": "trash", "st*pid": "stupid", "idiooot": "idiot", "i.d.i.o.t": "idiot",
        "l0ser": "loser", "p4thet1c": "pathetic", "d1sgu5ting": "disgusting", "$cum": "scum", "scummmm": "scum", "c l o w n": "clown",
    }.items():
        assert restore(form) == [word], form


def test_a_score_reads_the_restored_text(spark):
    clean = [(i, "the station is in it and of the station", 0) for i in range(60)]
    toxic = [(100 + i, f"the station is {WORDS[i % 10]} and it is {WORDS[i % 10]}", 1) for i in range(60)]
    docs = spark.createDataFrame([(i, t, 9.0, "en") for i, t, _ in clean + toxic], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in clean + toxic] + [(7, None, None), (None, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    asked = [(0, "you are an 1d10t"), (1, "i d i o t"), (2, "the station"), (3, ""), (4, None), (5, "x" * 100_000), (None, "such a l-o-s-e-r"), (6, "..."), (6, "...")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in asked], "doc_id long, text string, score int")
    got = [(r.doc_id, r.score) for r in toxicity.score(frame, model).collect()]
    assert [i for i, _ in got] == [i for i, _ in asked]
    assert [s >= toxicity.THRESHOLD for _, s in got] == [True, True, False, False, False, False, True, False, False]
    assert got[3][1] == got[4][1] == got[7][1] == pytest.approx(1 / (1 + math.exp(-model.bias)))


def test_tables_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(none, labels).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    assert {round(r.score, 6) for r in toxicity.score_documents(docs, labels).collect()} == {toxicity.PRIOR}


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_documents(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in held for b in held if a.toxic and not b.toxic]
    assert np.mean(pairs) > 0.8
    assert np.mean([r.predicted for r in held if not r.toxic]) < 0.05


def test_the_sample_is_bounded_and_leaves_out_the_held_out_fold(spark):
    from quillstream.llm.labelled import labelled_sample

    docs = spark.range(4000).selectExpr("id doc_id", "'t' text")
    labels = spark.range(4000).selectExpr("id doc_id", "cast(id % 2 as int) toxic")
    rows = labelled_sample(docs, labels, "toxic", 4, 2, max_rows=500).collect()
    assert 400 < len(rows) < 600
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.label == r.doc_id % 2 for r in rows)
    assert labelled_sample(docs, labels, "toxic", 4, 2).count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(4000))


def words_of(text, model):
    """Words whose hash is a feature of the text."""
    (block,) = list(blocks(pa.array([text]), lower=True))
    found = set(toxicity.restored_features(block, toxicity.Restorer(model)).hashes.tolist())
    return {w for w in WORDS if int(toxicity.span_hashes(*(np.array(x) for x in ([ord(c) for c in w], [0], [len(w)])))[0]) in found}


def test_spaced_letters_with_digits_and_signs():
    model = model_of([" ".join(WORDS * 5)])
    for text, word in {"the i d 1 o t is": "idiot", "1 d 1 o t": "idiot", "s t u p ! d": "stupid", "t r @ s h": "trash", "$ c u m": "scum", "l * s e r": "loser"}.items():
        assert word in words_of(text, model), text
    assert not words_of("in 1 2 3 4 5 is", model) - {"in", "is"}


def test_long_forms_are_not_cut(monkeypatch):
    restore = toxicity.Restorer(model_of([" ".join(WORDS * 5)]))
    for form in (".".join("disgusting" * 12), ".".join("1d10t" * 9 + "w0rthless" * 5), " ".join("pathetic" * 15)):
        found = restore(form)
        with monkeypatch.context() as m:
            m.setattr(toxicity, "PUT_ASIDE", 10**9, raising=False)  # whole texts in the states
            assert found == restore.search(form)
        # as often as it stands there; cuts every 40 characters left halves
        for word, n in (("disgusting", 12), ("pathetic", 15)):
            assert word[0] != form[0] or "".join(found) == word * n and found.count(word) == n, (form, found)
