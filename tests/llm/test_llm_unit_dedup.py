import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstream.llm import linededup, queries
from quillstream.llm.textarrays import blocks

UNIT = re.compile(r"[^.!?\n]*[.!?\n][.!? \t\r\n]*|[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")


def brute(rows):
    """Plain sequential version over (rank, text) rows: kept text and removed spans."""
    seen = {}
    for order, (rank, text) in enumerate(rows):
        for i, key in enumerate(keys(text)):
            if key:
                seen[key] = min(seen.get(key, (rank, 0)), (rank, 0))
    out = []
    for rank, text in rows:
        mine, kept, spans, at = set(), [], [], 0
        for unit, key in zip(UNIT.findall(text or ""), keys(text)):
            gone = key is not None and (seen[key][0] < rank or key in mine)
            mine.add(key)
            spans += [f"{at}-{at + len(unit)}"] if gone else []
            kept += [] if gone else [unit]
            at += len(unit)
        out.append((None if text is None else "".join(kept), ",".join(spans)))
    return out


def keys(text):
    words = [tuple(WORD.findall(u.lower())) for u in UNIT.findall(text or "")]
    out, before = [], []
    for w in words:
        key = [w]
        while sum(map(len, key)) < 5 and len(key) <= len(before):
            key.insert(0, before[-len(key)])
        out.append(tuple(key) if w and sum(map(len, key)) >= 5 else None)
        before += [w] if w else []
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab.!?\n \té1"), max_size=25), min_size=1, max_size=4))
def test_units_are_the_pattern(texts):
    for block in blocks(pa.array(texts), limit=30):
        starts = linededup.unit_starts(block).tolist() + [len(block.codes)]
        units = [block.slice(a, b) for a, b in zip(starts[:-1], starts[1:])]
        assert [u for u in units if u] == [u for i in range(block.count) for u in UNIT.findall(block.text(i))]


def test_table_against_brute_force(spark):
    line = "one two three four five six."
    rows = [
        (1, line + " Of. " + "another sentence with quite enough words here!\n" + line),
        (2, "Intro words that are only found here, ok. " + line.upper() + " Of. tail"),
        (3, "Of. Of. Of."), (4, ""), (5, None), (6, "...!!!\n\n"), (2, "Intro words that are only found here, ok. more"),
        (None, line), (20, "P. one two.\n\n- -\nthree\nfour\nfive six\n"), (21, "Q. one two.\nthree\n...\nfour\nfive six\n"), (7, "x " * 3000 + ". " + line), (8, line), (8, line),
    ]
    docs = spark.createDataFrame([(d, t, "u", 1.5) for d, t in rows], "doc_id long, text string, n_units string, score double")
    got = linededup.dedup_units(docs).collect()
    expected = brute([(linededup.LAST if d is None else d, t) for d, t in rows])
    assert Counter((r.doc_id, r.text, r.removed_spans, r.score) for r in got) == Counter((d, *e, 1.5) for (d, _), e in zip(rows, expected))
    for r in got:
        assert r.n_removed_units == len([s for s in r.removed_spans.split(",") if s])


def test_null_ids_are_documents_of_their_own(spark):
    line = "a long sentence that two texts have."
    texts = [f"{line} number {i}" for i in range(6)] + [None, "", f"{line} number 0"]
    out = linededup.dedup_units(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    keep = {r.text for r in out if r.text and line in r.text}
    assert len(keep) == 1 and sum(r.n_removed_units for r in out) == sum(bool(t) and t not in keep for t in texts)
    out = linededup.dedup_units(spark.createDataFrame([(None, line), (9, line)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in out} == {(None, ""), (9, line)}


def test_helper_names_may_clash(spark):
    line = "a long sentence that two texts have."
    docs = spark.createDataFrame([(1, line, 5, 6, "r", 7, 8)], "doc_id long, text string, _rank int, _VER int, _removed string, rank int, one int")
    both = docs.union(docs.selectExpr("2L", "text", "_rank", "_VER", "_removed", "rank", "one"))
    got = linededup.dedup_units(both)
    assert got.columns == [*docs.columns, *linededup.ADDED]
    assert {tuple(r)[:7] for r in got.collect()} == {(1, line, 5, 6, "r", 7, 8), (2, "", 5, 6, "r", 7, 8)}


def test_empty_table(spark):
    out = linededup.dedup_units(spark.createDataFrame([], "doc_id long, text string"))
    assert out.collect() == [] and out.columns == ["doc_id", "text", "n_units", "n_removed_units", "removed_spans"]


@pytest.mark.parametrize("scale", ["sf0.001"])
def test_sql(spark, scale):
    d = f"/root/testdata/{scale}"
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from read_parquet('{d}/documents.parquet')")
    want = duck.execute(queries.ORACLES["op8_unit_dedup"]).fetchall()
    got = queries.QUERIES["op8_unit_dedup"](spark, d).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert sum(r.n_removed_units for r in got) > 0
