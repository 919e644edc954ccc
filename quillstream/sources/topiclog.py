"""Topic logs: messages with (topic, partition, offset) coordinates.

A topic log is a DataFrame with the columns of Spark's public Kafka source
(``LOG_SCHEMA``), so the same operators run on

* a live Kafka stream (``kafka_stream``; needs the Kafka connector jar),
* a log persisted as Parquet, batch or stream (``read_topic_log`` /
  ``topic_log_stream``), stored partitioned by ``topic`` so a subscription is a
  partition-pruned scan,
* the deterministic fixture derived from ``documents`` (``documents_topic_log``).
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.functions.text import decode_utf8, encode_utf8
from quillstream.operators.joins import join_bounded
from quillstream.operators.numbering import number_within

LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# Fixed value: Kafka's number for "the earliest offset" in a startingOffsets JSON.
EARLIEST = -2

# Fixture parameters (documents -> log): partitions per topic and messages per batch.
FIXTURE_PARTITIONS_PER_TOPIC = 3
FIXTURE_BATCH_SIZE = 10


def parse_topics(topics: str | Iterable[str]) -> list[str]:
    """``"test,test2"`` -> ``["test", "test2"]``: split on commas, drop blanks and
    duplicates, keep first-seen order."""
    items = topics.split(",") if isinstance(topics, str) else list(topics)
    seen: dict[str, None] = {}
    for item in items:
        item = item.strip()
        if item:
            seen.setdefault(item, None)
    if not seen:
        raise ValueError("no topic given")
    return list(seen)


def subscribe(log: DataFrame, topics: str | Iterable[str]) -> DataFrame:
    """Keep the messages of the subscribed topics (pushed into the scan)."""
    return log.where(F.col("topic").isin(parse_topics(topics)))


def message_values(log: DataFrame, keep_coordinates: bool = True) -> DataFrame:
    """Drop the key and decode the value bytes as UTF-8 text."""
    value = decode_utf8("value").alias("value")
    if keep_coordinates:
        return log.select("topic", "partition", "offset", value)
    return log.select(value)


def with_batch_ids(log: DataFrame, batch_size: int) -> DataFrame:
    """Cut each partition into consecutive batches of ``batch_size`` offsets."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    # integer division: offsets are non-negative, so ``div`` is floor division
    return log.withColumn("batch_id", F.expr(f"`offset` div {int(batch_size)}"))


def _fixture_keyed(documents: DataFrame, topics: str | Iterable[str] | None) -> DataFrame:
    docs = documents.select("doc_id", "lang", "text").where("doc_id is not null")
    if topics is not None:
        docs = docs.where(F.col("lang").isin(parse_topics(topics)))
    return docs.select(
        F.col("lang").alias("topic"),
        (F.col("doc_id") % FIXTURE_PARTITIONS_PER_TOPIC).cast("int").alias("partition"),
        "doc_id",
        "text",
    )


def fixture_ends(documents: DataFrame) -> DataFrame:
    """``(topic, partition, end_offset)`` of the documents fixture. Its offsets are
    positions, so a partition ends at its number of rows: no numbering is needed."""
    return _fixture_keyed(documents, None).groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("end_offset"))


def fixture_offsets(documents: DataFrame, topics: str | Iterable[str] | None = None, keys_bound: int | None = None) -> DataFrame:
    """``(topic, partition, doc_id, offset)`` of the documents fixture; reads ``lang`` and ``doc_id`` only."""
    narrow = _fixture_keyed(documents, topics).select("topic", "partition", "doc_id")
    return number_within(narrow, ["topic", "partition"], "doc_id", "offset", keys_bound=keys_bound)


def documents_topic_log(
    documents: DataFrame,
    topics: str | Iterable[str] | None = None,
    batch_size: int = FIXTURE_BATCH_SIZE,
    keys_bound: int | None = None,
) -> DataFrame:
    """Deterministic topic log from the ``documents`` table.

    ``topic = lang``, ``partition = doc_id % 3``, ``offset`` = 0-based position
    by ``doc_id`` within (topic, partition), ``batch_id = offset div batch_size``,
    ``key`` = doc id as text, ``value`` = the document text (both as bytes).
    A topic subscription is applied before numbering, so it reaches the scan.
    Ids are unique; a row without one is not a message.

    Narrow rows are numbered. The offsets are then joined to the texts by id:
    broadcast when they are few, and otherwise in one shuffle of the texts.
    """
    offsets = fixture_offsets(documents, topics, keys_bound).select("doc_id", "offset")
    messages = _fixture_keyed(documents, topics)
    numbered = join_bounded(messages, offsets, ["doc_id"], small_rows=messages.count())
    log = numbered.select(
        "topic",
        "partition",
        "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
        encode_utf8(F.col("doc_id").cast("string")).alias("key"),
        encode_utf8("text").alias("value"),
    )
    return with_batch_ids(log, batch_size)


def fixture_tail(documents: DataFrame, starts: DataFrame, ends: DataFrame, most: int, keys_bound: int | None = None) -> DataFrame:
    """``(topic, partition, doc_id, offset)`` from each partition's start offset on.

    At most ``most`` messages of a partition (one batch) stand after its start, so
    only each partition's ``most`` largest ids are looked at: every scan task keeps
    that many a partition before anything is shuffled, and the log is not numbered.
    A message's offset is its partition's end less its place from the end.
    """
    narrow = _fixture_keyed(documents, None).select("topic", "partition", "doc_id")
    from_end = Window.partitionBy("topic", "partition").orderBy(F.desc("doc_id"))
    last = narrow.withColumn("_qs_place", F.row_number().over(from_end)).where(F.col("_qs_place") <= most)
    spans = starts.join(ends, ["topic", "partition"])
    placed = join_bounded(last, spans, ["topic", "partition"], small_rows=keys_bound)
    placed = placed.withColumn("offset", F.col("end_offset") - F.col("_qs_place"))
    return placed.where(F.col("offset") >= F.col("start_offset")).select("topic", "partition", "doc_id", "offset")


def tables_as_topics(sources: dict[str, DataFrame]) -> DataFrame:
    """Messages of several text tables as one multi-topic stream of values:
    ``{topic: DataFrame(value string)}`` -> ``(topic, value)``. Each table
    becomes one topic; the union is a plain ``UNION ALL`` (no shuffle)."""
    parts = [df.select(F.lit(topic).alias("topic"), F.col("value").cast("string").alias("value"))
             for topic, df in sources.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_topic_log(
    spark: SparkSession, path: str, topics: str | Iterable[str] | None = None
) -> DataFrame:
    """A topic log persisted as Parquet (ideally partitioned by ``topic``)."""
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    return subscribe(log, topics) if topics is not None else log


def write_topic_log(log: DataFrame, path: str, mode: str = "append") -> None:
    """Persist a log partitioned by topic, so subscriptions prune directories."""
    log.write.mode(mode).partitionBy("topic").parquet(path)


def topic_log_stream(
    spark: SparkSession,
    path: str,
    topics: str | Iterable[str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Replay a persisted log as a stream (file source, exactly-once offsets in
    the stream checkpoint)."""
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    log = reader.parquet(path)
    return subscribe(log, topics) if topics is not None else log


def starting_offsets_json(starts: DataFrame) -> str:
    """Render (topic, partition, start_offset) rows as the Kafka source's
    ``startingOffsets`` JSON. Runs on the driver at stream start; the input has
    one row per topic partition."""
    out: dict[str, dict[str, int]] = {}
    for row in starts.select("topic", "partition", "start_offset").toLocalIterator():
        out.setdefault(row.topic, {})[str(row.partition)] = int(row.start_offset)
    return json.dumps(out, sort_keys=True)


def assign_json(starts: DataFrame) -> str:
    """The Kafka source's ``assign`` JSON (``{"topic": [partitions]}``) for the
    partitions listed in ``starts`` (one row per topic partition)."""
    out: dict[str, list[int]] = {}
    for row in starts.select("topic", "partition").toLocalIterator():
        out.setdefault(row.topic, []).append(int(row.partition))
    return json.dumps({t: sorted(p) for t, p in out.items()}, sort_keys=True)


@dataclass(frozen=True)
class SourceSpec:
    """One Kafka source to open: either ``assign`` (explicit partitions with
    JSON start offsets) or ``subscribe`` (topics with a named start, or with a
    JSON that lists all of their partitions)."""

    starting_offsets: str
    assign: str | None = None
    subscribe: tuple[str, ...] = ()


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str | Iterable[str] | None = None,
    starting_offsets: str = "latest",
    assign: str | None = None,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Live Kafka source (requires the spark-sql-kafka package on the classpath).

    ``starting_offsets`` is ``"latest"`` (only new messages, the fresh-start
    default), ``"earliest"``, or a JSON from ``starting_offsets_json``. With
    ``topics`` and a JSON, Kafka refuses to start if a partition is not listed;
    with ``assign`` (from ``assign_json``) only the listed ones are read. Lost
    offsets (e.g. past retention) fail the query unless
    ``fail_on_data_loss=False``: nothing is skipped silently.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if assign is not None:
        reader = reader.option("assign", assign)
    else:
        reader = reader.option("subscribe", ",".join(parse_topics(topics or [])))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select(*[f.name for f in LOG_SCHEMA.fields])


def open_sources(spark: SparkSession, bootstrap_servers: str, specs: list[SourceSpec], **options) -> DataFrame:
    """Open the Kafka sources of a start plan and union them into one log."""
    frames = [
        kafka_stream(
            spark,
            bootstrap_servers,
            topics=list(spec.subscribe) or None,
            starting_offsets=spec.starting_offsets,
            assign=spec.assign,
            **options,
        )
        for spec in specs
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
