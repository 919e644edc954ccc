import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstream.llm import packing
from quillstream.llm.textarrays import blocks

FULL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD = [
    "", " ", "\n", "it's we'll don'tx ''s 's\n's", "a  b   c \n\n d", "tab\t\tx y", "x <|endoftext|> y", "été 12½ 東京!!",
    " lead", "trail  ", "'re've 'd'D", "a" * 50, "é", " x", "...'ll",
]


def ids_of(texts):
    tokens, out = packing.TokenIds(), []
    for block in blocks(pa.array(texts, pa.string()), limit=40):
        ids, offsets = tokens(block)
        out += [ids[offsets[i]:offsets[i + 1]].tolist() for i in range(block.count)]
    return out


def expected(text):
    return [*FULL.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_tokenizers():
    assert ids_of([*ODD, None]) == [expected(t) for t in [*ODD, None]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'strevld \n\t1é!½ "), max_size=30), max_size=4))
def test_ids_equal_the_tokenizers_on_random_texts(texts):
    assert ids_of(texts) == [expected(t) for t in texts]


def best_total(counts, room):
    """Brute force: the fullest total of a multiset of available lengths."""
    reach = {0}
    for length, n in enumerate(counts):
        for _ in range(int(n)):
            reach |= {r + length for r in reach if r + length <= room}
    return max(reach)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=12, max_size=12), st.integers(0, 30))
def test_fullest_is_the_fullest_and_available(raw, room):
    counts = np.array([0, *raw])
    parts = packing.fullest(counts, room)
    assert all(0 < n <= counts[length] for length, n in parts)
    assert sum(length * n for length, n in parts) == best_total(counts, room)


def test_patterns_use_every_piece_once():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 9, 65)
    counts[0] = 0
    used = np.zeros(65, dtype=int)
    bins = 0
    for n, parts in packing.fill_patterns(counts, 64):
        assert sum(length * k for length, k in parts) <= 64
        bins += n
        for length, k in parts:
            used[length] += n * k
    assert (used == counts).all()
    volume, large = -(-int((counts * np.arange(65)).sum()) // 64), int(counts[33:].sum())
    assert bins <= 1.05 * max(volume, large)


def check_layout(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pack_small_table(spark):
    texts = [*ODD, None, "copy me", "copy me", " ".join(str(i) for i in range(400))]
    docs = spark.createDataFrame(
        [(i if i != 3 else None, t, "x") for i, t in enumerate(texts)] + [(7, "dup", "y")] * 40, "doc_id long, text string, length string"
    )
    rows = packing.pack_documents(docs, capacity=64).collect()
    check_layout(rows, 64)
    by_doc = defaultdict(list)
    for r in rows:
        if r.doc_id not in (7,):
            by_doc[r.doc_id].append(r)
    for i, t in enumerate(texts):
        if i in (7,):
            continue
        ids, pieces = expected(t), sorted(by_doc[i if i != 3 else None], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert pieces[0].start == 0 and sum(p.length for p in pieces) == len(ids)
        assert all(p.length == 64 for p in pieces[1:])
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], dtype="<u4").tobytes())


def test_pack_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pack_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack_documents(docs).collect()
    n = check_layout(rows, packing.CAPACITY)
    total = sum(r.length for r in rows)
    assert n <= -(-total // packing.CAPACITY) + 1
    ids = packing.token_pieces(docs.where(F.col("doc_id") < 20), with_ids=True).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d in range(20):
        assert [x for r in sorted((r for r in ids if r.doc_id == d), key=lambda r: r.piece) for x in r.ids] == expected(texts[d])
