import math
import re
from collections import Counter

from quillstream.llm import decontam

TOKEN = re.compile(r"[\u0001\u0002]?[^\W\d_]+|[0-9]+(?:[.,][0-9]+)*")
UNIT_AFTER = re.compile(r"([0-9] ?)((?:" + "|".join(decontam.UNITS) + r")(?![^\W_]))")


def tokens(text):
    text = re.sub(r"(?<=[a-zéà,;:] )(?=[A-ZÉ][a-zé])", "\u0001", text or "")
    return TOKEN.findall(UNIT_AFTER.sub("\\1\u0002\\2", text).lower())


def kind(token):
    return "#" if token[0].isdigit() else token[0] if token[0] in "\u0001\u0002" else token


def brute(docs, items):
    """Windows of every document against windows of every item, one alignment after the other."""
    out = []
    asked = [(item, q, min(len(q), decontam.WINDOW)) for item, question in items if (q := tokens(question))]
    for doc_id, text in docs:
        found, hits = tokens(text), {}
        kinds, at_window = list(map(kind, found)), {}
        for size in {size for _, _, size in asked}:
            for i in range(len(found) - size + 1):
                at_window.setdefault(tuple(kinds[i:i + size]), []).append(i)
        for item, q, size in asked:
            aligned = {}
            for at in range(len(q) - size + 1):
                a = q[at:at + size]
                slots = [i for i, t in enumerate(a) if kind(t) != t]
                if 2 * (size - len(slots)) < size:
                    continue
                for i in at_window.get(tuple(map(kind, a)), []):
                    places, pairs = aligned.setdefault(i - at, (set(), set()))
                    places |= set(range(at, at + size))
                    pairs |= {(a[k], found[i + k]) for k in slots}
            covered = set()
            for places, pairs in aligned.values():
                if len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs}):
                    covered |= places
            if covered and len(covered) >= min(decontam.MIN_COVERED, math.ceil(len(q) * decontam.MIN_SHARE)):
                hits[item] = len(covered) / len(q)
        out.append((doc_id, bool(hits), len(hits), ",".join(map(str, sorted(hits))), max(hits.values(), default=0.0)))
    return Counter(out)


ITEMS = [
    (1, "If a train with Alice on board travels 60 km in 2 hours, then how far will it travel in 3 hours at 60 km per hour?"),
    (2, "short item here"), (3, ""), (4, None), (7, "to be or not to be that is the question whether to be nobler in the mind"),
    (9, "12 13 14 15 16 17 18 19 20 21"), (11, "Again the same words again the same words again the same words"), (12, "wer éte là so gehört"),
]
DOCS = [
    (1, "Intro. if a train with Bob on board travels 80 km in 5 hours, then how far will it travel in 7 hours at 80 km per hour? Outro"),
    (2, "if a train with Bob on board travels 80 km in 5 hours, then how far will it travel in 5 hours at 90 km per hour?"),
    (3, "some SHORT, item: here we are"), (4, ""), (5, None), (6, "to be or not to be that is"), (6, "say to be or not to be that is the question whether to be nobler"),
    (7, "1 2 3 4 5 6 7 8 9 10"), (None, "short item here"), (8, "again the same words " * 30), (8, "again the same words " * 30), (9, "Wer Éte là so gehört nicht"),
    (10, "nothing " * 500 + "of short items here"),
]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1, "z") for r in DOCS], "doc_id long, text string, key int, item_id string")
    items = spark.createDataFrame([(*r, 0) for r in ITEMS], "item_id long, text string, tokens int")
    got = decontam.flag_documents(docs, items).collect()
    want = brute(DOCS, ITEMS)
    assert Counter(map(tuple, got)) == want
    assert {r.doc_id for r in got if r.contaminated} >= {1, 3, None}  # other numbers and names; short items
    assert not any(r.contaminated for r in got if r.doc_id == 2)      # 60 stands for 80 and for 90
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == sum(n for row, n in want.items() if not row[1])


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(decontam, "MAX_BROADCAST_WINDOWS", 0)
    assert Counter(map(tuple, decontam.flag_documents(docs, items).collect())) == brute(DOCS, ITEMS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert decontam.flag_documents(none, no_items).count() == 0
    assert decontam.decontaminate(docs, no_items).count() == len(DOCS)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontam.flag_documents(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def hits(spark, docs, items):
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r.item_ids for r in decontam.flag_documents(docs, items).collect()}


def test_windows_of_mostly_slots_match_word_for_word(spark):
    items = ["What is 12 + 7 + 19 + 30 + 4?", "10 20 30 40 50 60 70 80 90 100 110 120 130", "1999"]
    docs = ["see here: what is 12 + 7 + 19 + 30 + 4? and so on", "what is 12 + 7 + 19 + 30 + 5? and so on", "x 10 20 30 40 50 60 70 80 90 100 110 120 130 y", "1 2 3 4 5 6 7 8 9 10 11 12 13"]
    assert hits(spark, docs, items) == {0: "0", 1: "", 2: "1", 3: ""}


def test_words_that_may_be_names(spark):
    items = ["What is the capital of France?", "Tom has 5 apples. Tom buys 3 more. How many has Tom?"]
    docs = [
        "Question: What is the capital of France?", "well, What is the capital of Spain?", "what is the capital of France?",
        "Sam has 7 apples. Sam buys 2 more. How many has Sam?", "Sam has 7 apples. Kim buys 2 more. How many has Pat?",
    ]
    assert hits(spark, docs, items) == {0: "0", 1: "0", 2: "0", 3: "1", 4: ""}
