"""Text column functions: single-space tokenising and newline line framing.

Both are built from native Spark expressions (no Python UDF), so they stay in
whole-stage codegen and run on the executors next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator the word splitter uses (one literal space) and
# the line terminators a line reader accepts (CR LF, CR, LF).
WORD_SEPARATOR = " "
LINE_BREAK = r"\r\n|\r|\n"
FINAL_LINE_BREAK = r"(\r\n|\r|\n)\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text: Column | str) -> Column:
    """Split on a single space with the semantics of ``java.util.regex.Pattern.split``.

    * inner and leading empty tokens are kept (``"a  b"`` -> ``a, "", b``);
    * trailing empty tokens are dropped (``"a "`` -> ``a``);
    * the empty string is one empty token; an all-space string has none;
    * tabs and newlines are not separators;
    * null gives null, which ``explode`` turns into no rows.

    Spark's own ``split(s, ' ')`` keeps trailing empties, so the trailing spaces
    are trimmed first (``rtrim`` strips only U+0020) and the rest is split with
    limit -1, which keeps the inner empties.
    """
    c = _col(text)
    trimmed = F.rtrim(c)
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, WORD_SEPARATOR, -1))
    )


def frame_lines(text: Column | str) -> Column:
    """Split a block of text into lines the way a newline-framed reader does.

    ``\\n``, ``\\r`` and ``\\r\\n`` end a line; a final terminator does not start
    another (empty) line; interior blank lines are kept; ``""`` has no line.

    Text without ``\\r`` (the usual case) takes a fast path: drop one final
    ``\\n`` and split on the single character, which needs no regex engine.
    Otherwise the terminator regex is used, anchored with ``\\z`` (``$`` would
    also match before a final terminator and lose a blank line).
    """
    c = _col(text)
    without_final_lf = F.when(c.endswith("\n"), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)
    fast = F.split(without_final_lf, "\n", -1)
    general = F.split(F.regexp_replace(c, FINAL_LINE_BREAK, ""), LINE_BREAK, -1)
    return (
        F.when(c == "", F.array().cast("array<string>"))
        .when(F.instr(c, "\r") == 0, fast)
        .otherwise(general)
    )


def decode_utf8(c: Column | str) -> Column:
    """Message bytes -> string (the string decoder of the topic consumer)."""
    return F.decode(_col(c), "UTF-8")


def encode_utf8(c: Column | str) -> Column:
    """String -> bytes, for the connector edges (keys, values, cells)."""
    return F.encode(_col(c), "UTF-8")
