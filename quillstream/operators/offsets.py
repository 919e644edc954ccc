"""Offset ranges per (batch, topic, partition), the offset ledger, and resume.

Ranges are half-open: ``from_offset`` inclusive, ``until_offset`` exclusive.
They are *dense*: every known partition has a row in every batch, an empty one
(``from == until``) when the batch read nothing from it. A resume therefore
restarts each partition from its state in the last batch, not from the last
batch that happened to touch it.

The ledger is append-only (one row per range plus the encoded ``stats``
string); the "current" position of a partition is derived from it (newest
range per key), so a replayed batch can never corrupt it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions.ledger_codec import decode_offset, encode_stats
from quillstream.operators.joins import join_bounded

PARTITION_KEY = ["topic", "partition"]
RANGE_COLUMNS = ["batch_id", "topic", "partition", "from_offset", "until_offset"]
LEDGER_COLUMNS = [*RANGE_COLUMNS, "stats"]

# Batches generated per row before the second expansion step (see ranges_of_ends).
BATCH_CHUNK = 4096


def partition_ends(log: DataFrame) -> DataFrame:
    """``(topic, partition, end_offset)``: one past the last offset present.
    A partial aggregation; the result has one row per topic partition."""
    return log.groupBy(*PARTITION_KEY).agg((F.max("offset") + 1).alias("end_offset"))


def batch_ranges(batch: DataFrame) -> DataFrame:
    """Non-empty ranges read by one batch of messages: ``(topic, partition,
    from_offset, until_offset)`` (used per micro-batch, where the batch is
    exactly what the source handed over)."""
    return batch.groupBy(*PARTITION_KEY).agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def last_batch(ends: DataFrame, batch_size: int) -> int | None:
    """The last non-empty batch of any partition (one aggregated row; None without rows)."""
    return ends.agg(F.max(F.expr(f"(end_offset - 1) div {int(batch_size)}")).alias("b")).first()["b"]


def _clipped(batches: DataFrame, n: int) -> DataFrame:
    return batches.select(
        "batch_id",
        *PARTITION_KEY,
        F.least(F.col("batch_id") * n, F.col("end_offset")).alias("from_offset"),
        F.least((F.col("batch_id") + 1) * n, F.col("end_offset")).alias("until_offset"),
    )


def last_ranges(ends: DataFrame, batch_size: int) -> DataFrame:
    """The last batch's dense ranges, one per partition: all that a resume needs."""
    last = last_batch(ends, batch_size)
    return _clipped(ends.withColumn("batch_id", F.lit(last).cast("long")).where(F.col("batch_id").isNotNull()), batch_size)


def ranges_of_ends(ends: DataFrame, batch_size: int, num_partitions: int | None = None) -> DataFrame:
    """Dense ranges of partitions ``(topic, partition, end_offset)`` cut into batches
    of ``batch_size`` offsets (batch ``b`` reads ``[b*n, (b+1)*n)`` clipped to the
    partition end), for batch ids ``0 .. last``, ``last`` being the last non-empty
    batch of any partition.

    The partition ends are spread first. The batch ids are then generated in two
    ``explode`` steps -- chunks of ``BATCH_CHUNK`` ids, a hash repartition of the
    chunks, then the ids of each chunk -- so no single task expands many or long
    partitions alone and no cross join is needed.
    """
    last = last_batch(ends, batch_size)
    # without an explicit count AQE may coalesce these exchanges when the rows
    # are few (the usual case); many spread over the cluster
    deal = lambda df, *keys: df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)
    chunked = deal(ends, *PARTITION_KEY).where(F.lit(last is not None)).withColumn(
        "_qs_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((last or 0) // BATCH_CHUNK).cast("long")))
    )
    first = F.col("_qs_chunk") * BATCH_CHUNK
    batches = deal(chunked, *PARTITION_KEY, "_qs_chunk").withColumn(
        "batch_id", F.explode(F.sequence(first, F.least(first + (BATCH_CHUNK - 1), F.lit(last or 0).cast("long"))))
    )
    return _clipped(batches, batch_size)


def dense_ranges(
    log: DataFrame,
    batch_size: int,
    num_partitions: int | None = None,
) -> DataFrame:
    """Dense ranges of a log (see ``ranges_of_ends``), from its partition ends."""
    return ranges_of_ends(partition_ends(log), batch_size, num_partitions)


def ledger_rows(ranges: DataFrame) -> DataFrame:
    """Ranges plus the encoded ``stats`` string: the rows appended to the ledger."""
    return ranges.select(*RANGE_COLUMNS, encode_stats().alias("stats"))


def ledger_current(ledger: DataFrame) -> DataFrame:
    """Newest ledger entry per topic partition: ``(topic, partition, batch_id, stats)``.

    Offsets only grow, so the newest range of a partition is the one with the
    greatest ``(until_offset, from_offset)``; an empty range at the end sorts
    after the range that reached it. Ordering by offsets rather than batch ids
    keeps the answer right across runs (batch ids restart when a stream starts
    on a new checkpoint), and a replayed batch, which writes the same range
    again, cannot change it. A partial aggregation; one row out per partition.
    """
    newest = ledger.groupBy(*PARTITION_KEY).agg(
        F.max_by(
            F.struct("batch_id", "from_offset", "until_offset"),
            F.struct("until_offset", "from_offset", "batch_id"),
        ).alias("_qs_n")
    )
    flat = newest.select(*PARTITION_KEY, "_qs_n.batch_id", "_qs_n.from_offset", "_qs_n.until_offset")
    return flat.select(*PARTITION_KEY, "batch_id", encode_stats().alias("stats"))


def resume_offsets(current: DataFrame, which: str = "from") -> DataFrame:
    """Start offset per topic partition, decoded from the ledger's ``stats``.

    ``which="from"`` starts at the last batch's ``fromOffset``: the last recorded
    batch is read again (at-least-once: a batch recorded before its output was
    written is not lost). ``which="until"`` starts after it.
    """
    if which not in ("from", "until"):
        raise ValueError("which must be 'from' or 'until'")
    return current.select(*PARTITION_KEY, decode_offset("stats", which).alias("start_offset"))


def resume_plan(
    current: DataFrame,
    requested_topics: list[str] | None = None,
    strict_ledger: bool = False,
    which: str = "from",
) -> DataFrame:
    """Start offsets for a resumed stream.

    By default the ledger's partitions of the requested topics are resumed; a
    requested topic the ledger does not know is left to the source's default
    start (it simply has no row here). ``strict_ledger=True`` resumes exactly
    the ledger's partitions whatever topics are requested.
    """
    starts = resume_offsets(current, which)
    if requested_topics and not strict_ledger:
        starts = starts.where(F.col("topic").isin(requested_topics))
    return starts


def resume_messages(
    log: DataFrame,
    starts: DataFrame,
    partitions_bound: int | None = None,
) -> DataFrame:
    """Messages at or after each partition's start offset; partitions without a
    start offset are not read. ``starts`` has one row per topic partition, so
    with a known ``partitions_bound`` it is broadcast and the log is not
    shuffled."""
    joined = join_bounded(log, starts, PARTITION_KEY, small_rows=partitions_bound)
    return joined.where(F.col("offset") >= F.col("start_offset")).drop("start_offset")


def fill_absent_partitions(
    ranges: DataFrame,
    previous: DataFrame | None,
    batch_id: int,
    partitions_bound: int | None = None,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Make one micro-batch's ranges dense: partitions known to the ledger
    (``previous`` = ``ledger_current``) or to the source (``positions``: topic,
    partition, position) but absent from the batch get an empty range, at the
    source's position or else at their last ``until_offset``."""
    known = []  # one row per topic partition each
    if previous is not None:
        known.append(previous.select(*PARTITION_KEY, decode_offset("stats", "until").alias("_qs_prev_until")))
    if positions is not None:
        known.append(positions.select(*PARTITION_KEY, F.col("position").cast("long").alias("_qs_position")))
    merged = ranges
    for other in known:
        merged = join_bounded(merged, other, PARTITION_KEY, how="full_outer", small_rows=partitions_bound)
    at = F.coalesce(*[F.col(c) for c in ("_qs_position", "_qs_prev_until") if c in merged.columns] or [F.lit(None).cast("long")])
    return merged.select(
        F.lit(batch_id).cast("long").alias("batch_id"),
        *PARTITION_KEY,
        F.coalesce("from_offset", at).alias("from_offset"),
        F.coalesce("until_offset", at).alias("until_offset"),
    )
