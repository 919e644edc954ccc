"""Property-based checks (Hypothesis) of the text functions against plain
Python models of single-space splitting and newline framing. Each example
is a batch of strings evaluated in one Spark job."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quillstream.functions.text import frame_lines, split_words

TEXTS = st.lists(st.text(alphabet=["a", "b", "é", " ", "\t", "\n", "\r"], max_size=16), min_size=1, max_size=60)


def model_split(s: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_lines(s: str) -> list[str]:
    out, cur, i = [], [], 0
    while i < len(s):
        ch = s[i]
        if ch in "\r\n":
            out.append("".join(cur))
            cur = []
            if ch == "\r" and s[i + 1 : i + 2] == "\n":
                i += 1
        else:
            cur.append(ch)
        i += 1
    if cur:
        out.append("".join(cur))
    return out


def _eval(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return {r.i: r.out for r in df.select("i", fn("t").alias("out")).collect()}


@settings(max_examples=25, deadline=None)
@given(texts=TEXTS)
def test_split_words_property(spark, texts):
    got = _eval(spark, split_words, texts)
    for i, t in enumerate(texts):
        assert got[i] == model_split(t), repr(t)


@settings(max_examples=25, deadline=None)
@given(texts=TEXTS)
def test_frame_lines_property(spark, texts):
    got = _eval(spark, frame_lines, texts)
    for i, t in enumerate(texts):
        assert got[i] == model_lines(t), repr(t)
