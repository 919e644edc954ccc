"""Audit of the ledger against what a streaming query says of its batches.

A query's progress holds each batch's start and end offsets per topic partition.
Compared with the ledger they show batches whose ranges were never recorded, and
recorded ranges that the query did not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.operators.offsets import PARTITION_KEY

RANGE_KEY = ["batch_id", *PARTITION_KEY]

_PROGRESS = "batchId long, sources array<struct<startOffset:string,endOffset:string>>"
_OFFSETS = "map<string,map<string,bigint>>"


def progress_frame(spark: SparkSession, progress: Iterable) -> DataFrame:
    """``(value)``: one JSON text per entry of ``query.recentProgress`` (at most
    ``spark.sql.streaming.numRecentProgressUpdates`` of them)."""
    texts = [p if isinstance(p, str) else p.json if hasattr(p, "json") else json.dumps(p) for p in progress]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def progress_ranges(progress: DataFrame) -> DataFrame:
    """``(batch_id, topic, partition, from_offset, until_offset)`` of progress JSON
    texts (``value``), also of a stored table of them.

    Only sources that number their partitions have ranges. The same batch may be
    reported more than once (idle triggers): the widest range counts.
    ``from_offset`` is null in a query's first batch and for a new partition.
    """
    sources = (
        progress.select(F.from_json("value", _PROGRESS).alias("p"))
        .select(F.col("p.batchId").alias("batch_id"), F.explode("p.sources").alias("s"))
        .select("batch_id", F.from_json("s.startOffset", _OFFSETS).alias("start"), F.from_json("s.endOffset", _OFFSETS).alias("end"))
    )
    topics = sources.select("batch_id", "start", F.explode("end").alias("topic", "parts"))
    ends = topics.select("batch_id", "topic", F.col("start")[F.col("topic")].alias("start"), F.explode("parts").alias("p", "until_offset"))
    ranges = ends.where("until_offset is not null").select(
        "batch_id", "topic", F.col("p").cast("int").alias("partition"), F.col("start")[F.col("p")].alias("from_offset"), "until_offset"
    )
    return ranges.groupBy(*RANGE_KEY).agg(F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"))


def audit_ledger(ledger: DataFrame, progress: DataFrame) -> DataFrame:
    """What does not agree: ``(batch_id, topic, partition, problem, ledger_from,
    ledger_until, progress_from, progress_until)``, no rows if all is well.

    * ``missing``: the query read offsets of the partition, the ledger has no range;
    * ``outside``: the ledger's range is not within what the query read (a shorter
      one is right where the topic has gaps);
    * ``unread``: the ledger has a range in a batch that was reported without the partition.

    Batches that the progress does not report are not judged. Give the rows of one
    run (``read_batches(...).where(run)``): batch ids start anew on a new checkpoint.
    """
    reported = progress_ranges(progress)
    batches = reported.select("batch_id").distinct()
    rows = ledger.join(batches, "batch_id", "left_semi").select(
        *RANGE_KEY, F.col("from_offset").alias("ledger_from"), F.col("until_offset").alias("ledger_until")
    )
    both = rows.join(reported.withColumnsRenamed({"from_offset": "progress_from", "until_offset": "progress_until"}), RANGE_KEY, "full_outer")
    some = F.coalesce(F.col("progress_from"), F.lit(-1)) < F.col("progress_until")
    outside = (F.col("ledger_from") < F.col("progress_from")) | (F.col("ledger_until") > F.col("progress_until"))
    problem = (
        F.when(F.col("ledger_until").isNull(), F.when(some, F.lit("missing")))
        .when(F.col("progress_until").isNull(), F.lit("unread"))
        .when(outside, F.lit("outside"))
    )
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull()).select(
        *RANGE_KEY, "problem", "ledger_from", "ledger_until", "progress_from", "progress_until"
    )
