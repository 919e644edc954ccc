"""Per-micro-batch word counting with an offset ledger and a cell-table sink.

Counts are per micro-batch, not cumulative: a streaming ``groupBy().count()``
would keep state across batches, so the counting runs as a plain batch
aggregation on each micro-batch inside ``foreachBatch``. ``process_batch`` is
that per-batch work as an ordinary function of a DataFrame; the streaming
wiring (``start_word_count_stream``) only hands batches to it.

Exactly-once input comes from the stream checkpoint (offsets are logged before
a batch runs, the commit after it). Outputs are written under the run label and
batch id with overwrite, so a batch replayed after a failure replaces its
earlier output, and a stream on a new checkpoint cannot overwrite an old run.
The batch's time and the positions of all its partitions, quiet ones included,
come from the checkpoint too and are the same on a replay.
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstream.functions.ledger_codec import encode_short
from quillstream.operators import cells as C
from quillstream.operators import counts
from quillstream.operators import offsets as O
from quillstream.session import shared_dir
from quillstream.sinks.tables import DEFAULT_RUN, compact_cells_in_place, compact_ledger_in_place, read_batches, run_label, write_batch
from quillstream.sources.topiclog import EARLIEST, SourceSpec, assign_json, starting_offsets_json
from quillstream.streaming.checkpoints import BatchInfo, batch_info, query_id

LOG = logging.getLogger("quillstream.offsets")


@dataclass(frozen=True)
class BatchOutputs:
    """Where each output of a batch goes (None = not produced)."""

    counts: str | None = None        # (word, total), one partition per batch
    ledger: str | None = None        # offset ranges + stats, one partition per batch
    cells: str | None = None         # counts as cells, one partition per batch
    text_col: str = "value"          # message text column (bytes are decoded)
    split_lines: bool = False        # frame text into lines before tokenising
    max_partitions: int | None = None  # bound on topic partitions (broadcast check)
    show_rows: int | None = None     # print this many count rows per batch (console)
    run: str = DEFAULT_RUN           # run label of the batch tables (one per checkpoint)
    log_ranges: bool = False         # log each range of the batch (one line per topic partition)
    checkpoint: str | None = None    # the stream's checkpoint: batch times and source positions
    compact_every: int | None = None  # merge the ledger's and the cells' batches in place this often


def _text(batch: DataFrame, col: str) -> DataFrame:
    c = F.col(col)
    is_binary = dict(batch.dtypes).get(col) == "binary"
    return batch.select((F.decode(c, "UTF-8") if is_binary else c).alias("value"))


def previous_positions(spark: SparkSession, ledger_path: str, batch_id: int, run: str) -> DataFrame | None:
    """Ledger rows that hold every partition's position before ``batch_id``.

    The ledger is dense, so the previous batch of the same run already lists
    every known partition: read just that partition directory. Only the first
    batch of a run (or one whose predecessor is missing) reads the whole
    ledger (a few segments and the batches since the last compaction), minus this run's own batches from ``batch_id`` on (a replay).
    """
    if batch_id > 0:
        prev = read_batches(spark, ledger_path, run=run, batch_ids=[batch_id - 1])
        if prev is not None:
            return prev
    ledger = read_batches(spark, ledger_path)
    if ledger is None:
        return None
    return ledger.where(~((F.col("run") == run) & (F.col("batch_id") >= batch_id)))


def batch_ledger_rows(
    batch: DataFrame,
    batch_id: int,
    ledger_path: str | None,
    run: str = DEFAULT_RUN,
    max_partitions: int | None = None,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Dense ledger rows for one batch: its non-empty ranges, plus an empty
    range for every partition that the ledger or the source (``positions``)
    knows and the batch did not read."""
    spark = batch.sparkSession
    previous = previous_positions(spark, ledger_path, batch_id, run) if ledger_path else None
    current = None if previous is None else O.ledger_current(previous)
    return O.ledger_rows(O.fill_absent_partitions(O.batch_ranges(batch), current, batch_id, max_partitions, positions))


def log_ranges(rows: DataFrame, batch_id: int) -> None:
    """Log a batch's dense ranges, empty ones included, one line per topic partition
    (the lines come to the driver)."""
    lines = rows.select(encode_short().alias("line"), *O.PARTITION_KEY)
    for row in lines.orderBy(*O.PARTITION_KEY).toLocalIterator():
        LOG.info("batch %d:%s", batch_id, row.line)


def _count_outputs(data: DataFrame, batch_id: int, outputs: BatchOutputs, time: datetime | None) -> None:
    """``time`` is the batch's time; without a stream's checkpoint it is unknown: the
    stored column is null then, and the header and the cells carry the clock's."""
    text = _text(data, outputs.text_col)
    words = counts.tokenize_lines(text) if outputs.split_lines else counts.tokenize(text)
    totals = counts.word_count_sql(words).persist()
    now = time or datetime.now(timezone.utc)
    stamp = F.timestamp_micros(F.lit(int(now.timestamp() * 1_000_000)))
    try:
        if outputs.counts:
            write_batch(totals.withColumn("batch_time", stamp if time else F.lit(None).cast("timestamp")), outputs.counts, batch_id, outputs.run)
        if outputs.cells and not totals.isEmpty():
            puts = C.stamp(C.counts_as_cells(totals), stamp, batch_id)
            write_batch(puts, outputs.cells, batch_id, outputs.run)
        if outputs.show_rows:
            print(f"=== batch {batch_id} at {now.isoformat(timespec='milliseconds')} ===")
            counts.top_words(totals, outputs.show_rows).show(outputs.show_rows, truncate=False)
    finally:
        totals.unpersist()


def process_batch(batch: DataFrame, batch_id: int, outputs: BatchOutputs) -> None:
    """All outputs of one micro-batch. The batch is persisted only when more
    than one output reads it (the ranges and the counts), so the source is
    read once; the counts are persisted because up to three outputs use them."""
    spark = batch.sparkSession
    has_offsets = {"topic", "partition", "offset"} <= set(batch.columns)
    wants_ranges = bool(outputs.ledger or outputs.log_ranges) and has_offsets
    wants_counts = bool(outputs.counts or outputs.cells or outputs.show_rows) and outputs.text_col in batch.columns
    shared = wants_ranges and wants_counts
    info = batch_info(spark, outputs.checkpoint, batch_id) if outputs.checkpoint else None
    info = info or BatchInfo(None, ())
    data = batch.persist() if shared else batch
    try:
        if wants_ranges:
            rows = batch_ledger_rows(
                data, batch_id, outputs.ledger, outputs.run, outputs.max_partitions, info.positions_frame(spark)
            ).persist()
            try:
                if outputs.ledger:
                    # one row per topic partition: one file per batch, not one per task
                    write_batch(rows, outputs.ledger, batch_id, outputs.run, files=1)
                if outputs.log_ranges:
                    log_ranges(rows, batch_id)
            finally:
                rows.unpersist()
        if wants_counts:
            _count_outputs(data, batch_id, outputs, info.time)
        if outputs.compact_every and batch_id % outputs.compact_every == outputs.compact_every - 1:
            if outputs.ledger:
                compact_ledger_in_place(spark, outputs.ledger)
            if outputs.cells:
                compact_cells_in_place(spark, outputs.cells)
    finally:
        if shared:
            data.unpersist()


def start_word_count_stream(
    source: DataFrame,
    outputs: BatchOutputs,
    name: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the per-batch word count. ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (default: every 2 seconds); the checkpoint
    defaults to ``<spark.checkpoint.dir>/streams/<name>``; the batch tables are
    labelled with the id of the query that owns it, so restarts replace their
    own batches and a new checkpoint, at whatever path, never overwrites old ones."""
    spark = source.sparkSession
    location = (checkpoint or shared_dir(spark, "streams", name)).rstrip("/")

    def run_batch(df: DataFrame, batch_id: int) -> None:
        session = df.sparkSession
        run = outputs.run if outputs.run != DEFAULT_RUN else run_label(query_id(session, location) or location)
        process_batch(df, batch_id, replace(outputs, run=run, checkpoint=location))

    writer = (
        source.writeStream.queryName(name)
        .option("checkpointLocation", location)
        .foreachBatch(run_batch)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
    )
    return writer.start()


def start_plan(
    spark: SparkSession,
    ledger_path: str,
    topics: list[str],
    default: str = "latest",
    which: str = "from",
    strict_ledger: bool = False,
    partitions: dict[str, list[int]] | None = None,
) -> list[SourceSpec]:
    """The Kafka sources a stream opens on a new checkpoint.

    * no recorded range: subscribe to ``topics`` at ``default``;
    * otherwise: subscribe to the requested topics the ledger knows, at its
      offsets, and, as another source, to the topics it does not know at
      ``default`` (a Kafka ``startingOffsets`` JSON must name every partition of
      its topics). ``partitions`` may list the topics' partitions now: one that
      the ledger lacks starts at its earliest offset. Without that list the
      source refuses an incomplete JSON and names the missing partitions, so
      none is passed over.
    * ``strict_ledger``: assign exactly the ledger's partitions, whatever topics
      are requested.
    """
    ledger = read_batches(spark, ledger_path)
    if ledger is None or ledger.isEmpty():
        return [SourceSpec(default, subscribe=tuple(topics))]
    starts = O.resume_plan(O.ledger_current(ledger), topics, strict_ledger, which).persist()
    try:
        if strict_ledger:
            return [SourceSpec(starting_offsets_json(starts), assign=assign_json(starts))]
        offsets = json.loads(starting_offsets_json(starts))  # one entry per topic partition
    finally:
        starts.unpersist()
    for topic in offsets:
        for p in (partitions or {}).get(topic, ()):
            offsets[topic].setdefault(str(p), EARLIEST)
    specs = []
    if offsets:
        specs.append(SourceSpec(json.dumps(offsets, sort_keys=True), subscribe=tuple(t for t in topics if t in offsets)))
    new = tuple(t for t in topics if t not in offsets)
    if new:
        specs.append(SourceSpec(default, subscribe=new))
    return specs
