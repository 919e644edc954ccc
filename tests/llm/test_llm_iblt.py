import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillstream.llm import iblt


def parts(text):
    return {p for p in re.split(r"\s*\n\s*|(?<=[.!?])\s+", text.strip(" ")) if p}


def jaccard(a, b):
    a, b = parts(a), parts(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows, hashes):
    """rows: (doc_id, text); the contract with plain sets."""
    key = lambda d, t: (iblt.FIRST if d is None else d, hashes[t])
    order = sorted({key(d, t or "") for d, t in rows}, reverse=True)
    texts = {key(d, t or ""): t or "" for d, t in rows}
    out = []
    for d, t in rows:
        t = t or ""
        k = key(d, t)
        after = texts[order[(order.index(k) + 1) % len(order)]]
        third = len(t) // 3
        edited = t[:len(t) - third] + after[:third]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(t, edited), 9), round(jaccard(t, after), 9)))
    return Counter(out)


def sample_rows():
    rng = random.Random(2)
    sentence = lambda: " ".join(rng.choice("alpha beta gamma delta été kappa".split()) for _ in range(rng.randrange(2, 7))) + rng.choice([".", "!", "\n"])
    rows = [(i, " ".join(sentence() for _ in range(rng.choice([0, 1, 2, 5, 30, 120])))) for i in range(0, 60, 2)]
    rows += [(101, rows[4][1]), (102, ""), (103, None), (None, "a null id. it comes last."), (None, None), (5, "twice. the same row."), (5, "twice. the same row."), (5, "another text. one id.")]
    return rows + [(7, "line one.\n" * 400 + "end"), (9, "\n\n  \n")]


def test_against_plain_sets(spark):
    rows = sample_rows()
    docs = spark.createDataFrame([(*r, 3, "k") for r in rows], "doc_id long, text string, n int, key string")
    hashes = {r.t: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("t")).distinct().withColumn("h", F.xxhash64("t")).collect()}
    got = iblt.fingerprints(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == brute(rows, hashes)
    by_text = {}
    for r in got:
        if r.doc_id is not None and r.doc_id not in (5,):
            text = dict(rows)[r.doc_id] or ""
            assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) >= len({frozenset(parts(t)) for t in by_text})


@pytest.mark.parametrize("n", [0, 1, 5, 40, 400])
def test_recovers_the_differing_digests(spark, n):
    digest = lambda i: int.from_bytes(hashlib.md5(str(i).encode()).digest()[:8], "big", signed=True)
    a, b = [digest(i) for i in range(50 + n)], [digest(i) for i in range(n, 50 + 2 * n)]
    one = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    base = lambda c: iblt.base_sketch(F.col(c))
    (row,) = one.select(iblt.differences(F.col("a"), F.col("b"), base("a"), base("b")).alias("d")).collect()
    assert Counter((e.x, e.s) for e in row.d) == Counter([(x, 1) for x in set(a) - set(b)] + [(x, -1) for x in set(b) - set(a)])


def test_signed_sums_are_the_subtracted_sketches(spark):
    digests = [hash((i, "y")) for i in range(40)]
    one = spark.createDataFrame([(digests[:30], digests[10:])], "a array<long>, b array<long>")
    signed = F.concat(iblt._signed(F.col("a"), 1), iblt._signed(F.col("b"), -1))
    apart = iblt.subtract(*[iblt.sketch(iblt._signed(F.col(c), 1), 36, 2) for c in "ab"])
    assert one.select((iblt.sketch(signed, 36, 2) == apart).alias("same")).first().same


@pytest.mark.parametrize("n", [1, 3, 60])
def test_a_sketch_that_never_peels_is_settled_exactly(spark, monkeypatch, n):
    monkeypatch.setattr(iblt, "LADDER", ())
    a, b = [hash((i, "z")) for i in range(50)], [hash((i, "z")) for i in range(n, 50 + n)]
    one = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    base = lambda c: iblt.base_sketch(F.col(c))
    (row,) = one.select(iblt.differences(F.col("a"), F.col("b"), base("a"), base("b"), 30).alias("d")).collect()
    assert Counter((e.x, e.s) for e in row.d) == Counter([(x, 1) for x in set(a) - set(b)] + [(x, -1) for x in set(b) - set(a)])


def test_a_failing_sketch_says_so(spark):
    digests = [hash((i, "x")) for i in range(200)]
    one = spark.createDataFrame([(digests,)], "a array<long>").select(iblt.base_sketch(F.col("a")).alias("c"))
    assert one.select(iblt.peel(F.col("c"), iblt.CELLS, 0).alias("p")).first().p is None


def test_single_and_empty_tables(spark):
    (row,) = iblt.fingerprints(spark.createDataFrame([(1, "only one. document here.")], "doc_id long, text string")).collect()
    assert row.near_next == 1.0
    out = iblt.fingerprints(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = iblt.fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
