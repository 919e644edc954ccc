"""The registered queries: each takes ``(spark, table_dir)`` and returns a
DataFrame over the whole of the tables in ``table_dir``.

Inputs are the driver tables: ``documents`` (message text; also the source of
the topic-log fixture, see ``sources.topiclog.documents_topic_log``) and
``events`` (the source of the cell table, see ``operators.cells.events_as_cells``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.operators import cells as C
from quillstream.operators import counts
from quillstream.operators import offsets as O
from quillstream.operators.joins import join_bounded
from quillstream.operators.reduce import last_by
from quillstream.operators.windows import sliding_count
from quillstream.sources.tables import read_table, spread
from quillstream.sources.topiclog import (
    FIXTURE_BATCH_SIZE,
    documents_topic_log,
    fixture_ends,
    fixture_tail,
    message_values,
    parse_topics,
    tables_as_topics,
)

Query = Callable[[SparkSession, str], DataFrame]

# Query parameters.
SUBSCRIBED_TOPICS = "en,de"          # two of the four topics of the log fixture
TEXT_TOPICS = "documents,conversations"  # two tables read as two topics
TOP_N = 10                           # rows shown per batch by the console sink
UPSERT_CUTOVER = "2024-01-15 00:00:00"  # puts of older events are moved to this time
UPSERT_SEQ = 1 << 40                 # write sequence of the puts' copies, after every event's


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents", ["doc_id", "lang", "text"])


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents for text work, spread over the cores if the scan is narrow."""
    return spread(_documents(spark, d), ["doc_id"])


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return counts.tokenize(_texts(spark, d), "text")


def _log(spark: SparkSession, d: str, topics: str | None = None) -> DataFrame:
    """The topic-log fixture; its few topic partitions are counted to bound the small tables."""
    docs = _documents(spark, d)
    wanted = parse_topics(topics) if topics else None
    return documents_topic_log(docs, wanted, keys_bound=fixture_ends(docs).count())


def _ledger_current(ends: DataFrame) -> DataFrame:
    """The ledger's current entries: those of the last batch, as ranges are dense."""
    return O.ledger_current(O.ledger_rows(O.last_ranges(ends, FIXTURE_BATCH_SIZE)))


# --- text and counts -------------------------------------------------------

def q_words(spark: SparkSession, d: str) -> DataFrame:
    """one row per token of every document: (doc_id, word)."""
    return counts.tokenize(_texts(spark, d), "text", keep=["doc_id"])


def q_word_count(spark: SparkSession, d: str) -> DataFrame:
    """A2: 64-bit word counts over all documents."""
    return counts.word_count(_tokens(spark, d))


def q_word_count_pairs(spark: SparkSession, d: str) -> DataFrame:
    """A1: the same counts as 32-bit totals (overflow raises)."""
    return counts.word_count_int(_tokens(spark, d))


def q_word_count_sql(spark: SparkSession, d: str) -> DataFrame:
    """The counting statement in SQL over the tokens (flagship)."""
    return counts.word_count_sql(_tokens(spark, d))


def q_line_word_count(spark: SparkSession, d: str) -> DataFrame:
    """S3/F2: counts after framing the texts into lines, as a line source delivers them."""
    return counts.word_count(counts.tokenize_lines(_texts(spark, d), "text"))


def q_top_words(spark: SparkSession, d: str) -> DataFrame:
    """K1: the ten most frequent words, ties by word (distributed top-k)."""
    return counts.top_words(counts.word_count(_tokens(spark, d)), TOP_N)


def q_two_topic_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Counts per topic over two subscribed topics, one per text table."""
    ids = {"documents": ["doc_id"], "conversations": ["conv_id", "turn"]}
    sources = {
        t: spread(read_table(spark, d, t, [*ids[t], "text"]), ids[t]).withColumnRenamed("text", "value")
        for t in parse_topics(TEXT_TOPICS)
    }
    return counts.word_count(counts.tokenize(tables_as_topics(sources), keep=["topic"]), by=["topic"])


# --- topic log, batches, offsets -------------------------------------------

def q_topic_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages of two subscribed topics, values decoded."""
    return message_values(_log(spark, d, SUBSCRIBED_TOPICS))


def q_batch_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Counts per batch of the topic log, not cumulative."""
    msgs = _log(spark, d).select("batch_id", F.decode("value", "UTF-8").alias("value"))
    return counts.batch_word_count(counts.tokenize(msgs, "value", keep=["batch_id"]))


def q_offset_ranges(spark: SparkSession, d: str) -> DataFrame:
    """A4/K7: dense offset ranges per (batch, topic, partition)."""
    return O.ranges_of_ends(fixture_ends(_documents(spark, d)), FIXTURE_BATCH_SIZE)


def q_offset_ledger(spark: SparkSession, d: str) -> DataFrame:
    """K6/F8: the ledger's current entry per topic partition."""
    return _ledger_current(fixture_ends(_documents(spark, d)))


def q_resume_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Start offsets decoded from the ledger (fromOffset: replays the last batch)."""
    return O.resume_offsets(_ledger_current(fixture_ends(_documents(spark, d))), "from")


def _resumed(spark: SparkSession, d: str) -> DataFrame:
    """Messages from the resume position on.

    Start offsets and ends come from counts. What stands after a start is at most
    one batch per partition, so only each partition's last ids are ranked, and the
    log is not numbered. Those ids are few (``batch_size * keys``): they are broadcast
    into a scan of the documents, so the text column is never shuffled.
    """
    docs = _documents(spark, d)
    ends = fixture_ends(docs)
    keys = ends.count()
    starts = O.resume_offsets(_ledger_current(ends), "from")
    picked = fixture_tail(docs, starts, ends, FIXTURE_BATCH_SIZE, keys_bound=keys)
    texts = docs.select("doc_id", F.col("text").alias("value"))
    found = join_bounded(texts, picked, ["doc_id"], small_rows=FIXTURE_BATCH_SIZE * keys)
    return found.select("topic", "partition", "offset", "value")


def q_resume_messages(spark: SparkSession, d: str) -> DataFrame:
    """The messages a resumed stream reads."""
    return _resumed(spark, d)


def q_resume_word_count(spark: SparkSession, d: str) -> DataFrame:
    """T5/A3: counts of the resumed messages."""
    return counts.word_count(counts.tokenize(_resumed(spark, d), "value"))


# --- cells ------------------------------------------------------------------

def q_word_cells(spark: SparkSession, d: str) -> DataFrame:
    """K4: word counts as cells (row key = word, w1:total)."""
    return C.counts_as_cells(counts.word_count(_tokens(spark, d)))


def q_cell_scan(spark: SparkSession, d: str) -> DataFrame:
    """Newest version of every cell of the events cell table."""
    return C.newest_cells(C.events_as_cells(_events(spark, d)))


def q_cell_key_values(spark: SparkSession, d: str) -> DataFrame:
    """Each newest cell as 'row/family:qualifier/timestamp' and its value."""
    return C.key_values(C.newest_cells(C.events_as_cells(_events(spark, d))))


def q_cell_rows(spark: SparkSession, d: str) -> DataFrame:
    """Whole rows of an open schema: all newest cells of each row key, in one pass."""
    return C.row_strings(C.events_as_cells(_events(spark, d)))


def q_cell_upsert(spark: SparkSession, d: str) -> DataFrame:
    """K5: the events' cell table after a batch of puts.

    Every event is put again, its value marked with ``!``. Events with an even
    sequence keep their time but are put with an earlier sequence, so they lose to
    the cell that is there; the others, moved to the cut-over time if they are
    older, replace older cells, the smallest sequence last.
    """
    cells = C.events_as_cells(_events(spark, d))
    cut = F.lit(UPSERT_CUTOVER).cast("timestamp_ntz")
    old = F.col("seq") % 2 == 0
    puts = cells.select(
        *C.CELL_KEY,
        F.when(old | (F.col("ts") >= cut), F.col("ts")).otherwise(cut).alias("ts"),
        F.when(old, F.col("seq") - UPSERT_SEQ).otherwise(UPSERT_SEQ - F.col("seq")).alias("seq"),
        F.concat(F.col("value"), F.lit("!")).alias("value"),
    )
    return C.upsert(cells, puts)


def q_last_value_per_key(spark: SparkSession, d: str) -> DataFrame:
    """A5: last value per user by an explicit (ts, event_id) order."""
    return last_by(_events(spark, d), ["user_id"], "value", ["ts", "event_id"])


# --- event-time windows -------------------------------------------------------

def q_sliding_count(spark: SparkSession, d: str) -> DataFrame:
    """X1 (extension): events per type in 10-minute windows that start every 5 minutes."""
    counted = sliding_count(read_table(spark, d, "events", ["ts", "event_type"]), "ts", "event_type")
    # without zone, as the events' times are
    return counted.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


QUERIES: dict[str, Query] = {
    "words": q_words,
    "word_count": q_word_count,
    "word_count_pairs": q_word_count_pairs,
    "word_count_sql": q_word_count_sql,
    "line_word_count": q_line_word_count,
    "top_words": q_top_words,
    "two_topic_word_count": q_two_topic_word_count,
    "topic_messages": q_topic_messages,
    "batch_word_count": q_batch_word_count,
    "offset_ranges": q_offset_ranges,
    "offset_ledger": q_offset_ledger,
    "resume_offsets": q_resume_offsets,
    "resume_messages": q_resume_messages,
    "resume_word_count": q_resume_word_count,
    "word_cells": q_word_cells,
    "cell_scan": q_cell_scan,
    "cell_key_values": q_cell_key_values,
    "cell_rows": q_cell_rows,
    "cell_upsert": q_cell_upsert,
    "last_value_per_key": q_last_value_per_key,
    "sliding_count": q_sliding_count,
}
