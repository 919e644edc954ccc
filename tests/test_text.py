"""Tokeniser and line framing on the edge strings the driver tables lack."""

import pytest

from quillstream.functions.text import frame_lines, split_words
from quillstream.operators import counts

# (input, tokens) -- single-space splitting with trailing empties dropped
WORD_CASES = [
    ("", [""]),
    ("a", ["a"]),
    (" ", []),
    ("   ", []),
    ("a b", ["a", "b"]),
    ("a  b", ["a", "", "b"]),
    (" a", ["", "a"]),
    ("a ", ["a"]),
    ("a b  ", ["a", "b"]),
    ("  a  b  ", ["", "", "a", "", "b"]),
    ("a\tb", ["a\tb"]),
    ("a\nb ", ["a\nb"]),
    ("héllo wörld", ["héllo", "wörld"]),
]

LINE_CASES = [
    ("", []),
    ("a", ["a"]),
    ("a\n", ["a"]),
    ("a\r\n", ["a"]),
    ("\n", [""]),
    ("\r", [""]),
    ("\n\n", ["", ""]),
    ("a\n\nb", ["a", "", "b"]),
    ("a\r\nb\rc\n", ["a", "b", "c"]),
    ("a\n\n", ["a", ""]),
]


def _apply(spark, fn, cases):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(cases)], "i int, s string")
    return {r.i: r.out for r in df.select("i", fn("s").alias("out")).collect()}


@pytest.mark.parametrize("idx", range(len(WORD_CASES)))
def test_split_words(spark, idx):
    got = _apply(spark, split_words, WORD_CASES)
    assert got[idx] == WORD_CASES[idx][1], repr(WORD_CASES[idx][0])


@pytest.mark.parametrize("idx", range(len(LINE_CASES)))
def test_frame_lines(spark, idx):
    got = _apply(spark, frame_lines, LINE_CASES)
    assert got[idx] == LINE_CASES[idx][1], repr(LINE_CASES[idx][0])


def test_null_text_gives_no_token(spark):
    df = spark.createDataFrame([(None,), ("x",)], "value string")
    assert [r.word for r in counts.tokenize(df).collect()] == ["x"]
    assert [r.line for r in counts.frame(df).collect()] == ["x"]


def test_empty_token_is_counted(spark):
    df = spark.createDataFrame([("a  a",), ("",)], "value string")
    got = {r.word: r.total for r in counts.word_count(counts.tokenize(df)).collect()}
    assert got == {"a": 2, "": 2}


def test_tokens_match_python_reference_split(spark):
    """Property check against a plain-Python model of the splitter."""
    import random

    rnd = random.Random(7)
    alphabet = ["a", "b", " ", " ", "\t", "\n", "é"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]

    def model(s):
        parts = s.split(" ")
        if s == "":
            return [""]
        while parts and parts[-1] == "":
            parts.pop()
        return parts

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.w for r in df.select("i", split_words("t").alias("w")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == model(t), repr(t)


def test_lines_match_readline_model(spark):
    """Property check against a model of a newline-framed line reader."""
    import random

    def read_lines(s):
        out, cur, i = [], [], 0
        while i < len(s):
            ch = s[i]
            if ch == "\n" or ch == "\r":
                out.append("".join(cur))
                cur = []
                if ch == "\r" and i + 1 < len(s) and s[i + 1] == "\n":
                    i += 1
            else:
                cur.append(ch)
            i += 1
        if cur:
            out.append("".join(cur))
        return out

    rnd = random.Random(11)
    alphabet = ["a", "b", " ", "\n", "\r", "\r\n"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 10))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.l for r in df.select("i", frame_lines("t").alias("l")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == read_lines(t), repr(t)
