import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from quillstream.llm import convtrie, queries

DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            by_conv[conv].append((turn is not None, turn or 0, tie, role, text))
    original = {c: [t[3:] for t in sorted(ts)] for c, ts in by_conv.items()}
    whole = {}
    for c, ts in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(original.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + ts[h:])
    members = defaultdict(list)
    members[()] = []
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * words(p) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        out.append((
            min(m, default=None), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == convtrie.NODE_COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(seed, n, long=0):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(4 * n), n):
        for t in range(rnd.choice([1, 2, 3, 5, 9])):
            rows.append((c, t, rnd.choice(["user", "bot"]), rnd.choice(["a", "a b", "", "c\td e"])))
    rows += [(7 * n, t, "user", f"x {t % 3}") for t in range(long)] + [(7 * n + 1, t, "user", f"x {t % 3}") for t in range(long - 5)]
    return rows


@pytest.mark.parametrize("seed, block, span, hot", [(1, 4, 1024, 1000), (2, 1, 2, 3), (3, 3, 1, 1000), (4, 8, 4, 1)])
def test_against_brute_force(spark, monkeypatch, seed, block, span, hot):
    for name, value in (("BLOCK", block), ("SPAN", span), ("HOT", hot), ("CHUNK", 16)):
        monkeypatch.setattr(convtrie, name, value)
    rows = made(seed, 80, long=60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(convtrie.trie(df)) == brute(rows)


def test_defined_cases(spark):
    rows = [
        (None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, "", ""),
        (-40, 1, "user", "a"), (-33, 1, "user", "b"), (-33, 2, "u", "ser b"), (2**62, 0, "user", "word " * 20000), (25, 0, "us", "erb"), (26, 0, "user", "b"),
    ]
    wide = spark.createDataFrame([(*r, 5, "z") for r in rows], SCHEMA + ", depth int, words string")
    assert got(convtrie.trie(wide)) == brute(rows)
    none = hashlib.sha256(b"").hexdigest()
    assert got(convtrie.trie(wide.limit(0))) == [(None, 0, None, 0, 0, 1, 0, none)]


def test_turnless_conversations_end_at_the_root(spark):
    few = [c for c in range(41, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:5]
    rows = [(c, t, "user", "a") for c in few for t in range(2)]
    assert got(convtrie.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert brute(rows)[0][3] == 5


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op13_conversation_trie"](spark, DIR)) == brute(rows)
