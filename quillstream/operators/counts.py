"""Word counting: tokens, per-key counts (64- and 32-bit), SQL form, per-batch
form and the ordered top rows.

Every function is DataFrame -> DataFrame, so the same code runs on a static
table and on each micro-batch inside ``foreachBatch``. Counting is a
``groupBy().agg(count)``: partial aggregation on the map side collapses even a
very hot word to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions.text import frame_lines, split_words

# Fixed value: the per-batch counting statement, as the reference states it.
WORD_COUNT_SQL = "select word, count(*) as total from {words} group by word"


def tokenize(df: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per token of ``text_col``: columns ``keep`` + ``word``."""
    return df.select(*keep, F.explode(split_words(text_col)).alias("word"))


def frame(df: DataFrame, text_col: str = "value", keep: Sequence[str] = (), out_col: str = "line") -> DataFrame:
    """One row per newline-framed line of ``text_col``."""
    return df.select(*keep, F.explode(frame_lines(text_col)).alias(out_col))


def tokenize_lines(df: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Frame text into lines, then tokenise every line."""
    return tokenize(frame(df, text_col, keep, out_col="_qs_line"), "_qs_line", keep)


def word_count(words: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., word, total long)``."""
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("total"))


def word_count_int(words: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Same counts as a 32-bit ``total``; under ANSI mode an overflowing count
    raises instead of wrapping."""
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).cast("int").alias("total"))


def word_count_sql(words: DataFrame) -> DataFrame:
    """The SQL form, run against ``words`` bound as a query parameter (no global
    temp-view name to clash between concurrent batches)."""
    return words.sparkSession.sql(WORD_COUNT_SQL, words=words.select("word"))


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent words, ties by word: a distributed top-k
    (``TakeOrderedAndProject``), not a full sort."""
    return counts.orderBy(F.col("total").desc(), F.col("word").asc()).limit(n)


def batch_word_count(words: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Counts per batch (not cumulative): ``(batch_id, word, total)``."""
    return word_count(words, by=[batch_col])
