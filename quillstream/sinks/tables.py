"""Idempotent, batch-keyed table writers.

Every stream output is written under its run and batch id
(``<table>/run=<label>/batch_id=<n>/``) with overwrite, so a micro-batch that is
replayed after a failure replaces its own earlier output instead of adding to
it. The run label comes from the streaming query's id, which lives in the
checkpoint: it is the same after every restart, and a checkpoint that is deleted
and made again, even at the same path, has a new id and cannot overwrite an
earlier run. Puts and compacted tables use the same layout (``run=put-<id>``,
``run=compacted``), so one reader sees every write. Readers see ``run`` and
``batch_id`` as partition columns and can prune on them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from quillstream.functions.ledger_codec import decode_offset
from quillstream.operators.cells import CELL_KEY, CELL_SCHEMA, lookup
from quillstream.operators.offsets import ledger_current
from quillstream.sinks import manifest

DEFAULT_RUN = "default"


def run_label(query_id: str) -> str:
    """A stable, non-numeric label for the run of a streaming query."""
    return "r" + hashlib.sha1(query_id.encode("utf-8")).hexdigest()[:12]


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at its path."""
    return error.getCondition() == "PATH_NOT_FOUND"


def batch_path(table_path: str, batch_id: int, run: str = DEFAULT_RUN) -> str:
    return f"{table_path.rstrip('/')}/run={run}/batch_id={int(batch_id)}"


def write_batch(
    df: DataFrame, table_path: str, batch_id: int, run: str = DEFAULT_RUN, files: int | None = None
) -> None:
    """Replace the partition of (run, batch_id) with ``df`` (the directory
    carries ``run`` and ``batch_id``, so those columns are dropped)."""
    out = df.drop("batch_id", "run")
    if files:
        out = out.coalesce(files)
    out.write.mode("overwrite").parquet(batch_path(table_path, batch_id, run))


def read_batches(
    spark: SparkSession,
    table_path: str,
    schema=None,
    run: str | None = None,
    batch_ids: Iterable[int] | None = None,
) -> DataFrame | None:
    """The batch-keyed table, or None if there is no such batch. The whole table is
    what the newest manifest names (``sinks.manifest``): segments, and the batches since;
    with ``run`` or ``batch_ids``, only those batch folders are listed. Anything
    else that keeps the table from being read is raised."""
    if run is None and batch_ids is None:
        now = manifest.current(spark, table_path)
        live = manifest.live_folders(spark, table_path, now)
        return _read_parts(spark, table_path, live, [v for v, _ in now.segments], schema)
    reader = spark.read.option("basePath", table_path)
    if schema is not None:
        reader = reader.schema(schema)
    ids = "*" if batch_ids is None else "{" + ",".join(str(int(b)) for b in batch_ids) + "}"
    try:
        return reader.parquet(f"{table_path.rstrip('/')}/run={run or '*'}/batch_id={ids}")
    except AnalysisException as error:
        if is_absent(error):
            return None
        raise


def _read_parts(spark: SparkSession, table_path: str, folders: list[str], segments: list[int], schema=None) -> DataFrame | None:
    """Rows of batch folders and segments, with ``run`` and ``batch_id``."""
    base, parts = table_path.rstrip("/"), []
    if folders:
        reader = spark.read.option("basePath", base)
        parts.append((reader.schema(schema) if schema is not None else reader).parquet(*[f"{base}/{f}" for f in folders]))
    if segments:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]))
        parts.append(reader.parquet(*[manifest.segment_path(base, v) for v in segments]))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest_of(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row of the newest version of each key, with all its columns (a partial aggregation)."""
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_qs_v"))
    return newest.select(*keys, *[F.col(f"_qs_v.{c}").alias(c) for c in rest])


def compact_ledger_in_place(spark: SparkSession, ledger_path: str) -> None:
    """Merge the ledger's finished batches into segments of one row per topic partition.
    Resuming is the same before, during and after; the folders stay few."""
    keys, version = ["topic", "partition"], ["until_offset", "from_offset", "batch_id"]
    read = lambda folders, segments: _read_parts(spark, ledger_path, folders, segments).withColumn("batch_id", F.col("batch_id").cast("long"))
    manifest.compact(spark, ledger_path, read, lambda rows: _newest_of(rows, keys, version))


def compact_cells_in_place(spark: SparkSession, cells_path: str) -> None:
    """Merge the finished batches and puts of a stored cell table into segments that hold
    the newest version of each cell, range partitioned and sorted by cell key. What
    a scan returns is the same before, during and after."""
    read = lambda folders, segments: _read_parts(spark, cells_path, folders, segments, CELL_SCHEMA).withColumn("batch_id", F.col("batch_id").cast("long"))
    manifest.compact(spark, cells_path, read, lambda rows: _newest_of(rows, CELL_KEY, ["ts", "seq"]), layout=CELL_KEY)


def lookup_cells(spark: SparkSession, cells_path: str, row_key: str) -> DataFrame:
    """Point read of one whole row (newest versions) of a stored cell table: of each
    segment only the files whose key range holds ``row_key``, and the batches since
    the last compaction, both filtered in the Parquet scan."""
    now = manifest.current(spark, cells_path)
    rows = _read_parts(spark, cells_path, manifest.live_folders(spark, cells_path, now), [], CELL_SCHEMA)
    files = manifest.files_with(spark, cells_path, now, row_key)
    columns = [f.name for f in CELL_SCHEMA.fields]
    parts = ([rows.select(*columns)] if rows is not None else []) + ([spark.read.schema(CELL_SCHEMA).parquet(*files)] if files else [])
    if not parts:
        return lookup(spark.createDataFrame([], CELL_SCHEMA), row_key)
    return lookup(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), row_key)


def compact_cells(spark: SparkSession, cells_path: str, out_path: str) -> None:
    """Rewrite a cell table keeping only the newest version of every cell
    (with its ``seq``), into a new location (run ``compacted``). Later stream
    batches and puts go beside it and still win over the compacted versions,
    since versions are compared by (ts, seq)."""
    if read_batches(spark, out_path) is not None:
        raise ValueError(f"{out_path} already holds a table")
    newest = read_cells(spark, cells_path).groupBy(*CELL_KEY).agg(
        F.max_by(F.struct("ts", "seq", "value"), F.struct("ts", "seq")).alias("_qs_v")
    )
    write_batch(newest.select(*CELL_KEY, "_qs_v.ts", "_qs_v.seq", "_qs_v.value"), out_path, 0, COMPACTED_RUN)


COMPACTED_RUN = "compacted"


def compact_ledger(spark: SparkSession, ledger_path: str, out_path: str) -> None:
    """Rewrite an offset ledger as one dense batch holding every partition's
    current range, into a new location (run ``compacted``, batch id = the
    newest batch id). A resume from the compacted ledger starts exactly where
    one from the full ledger would."""
    ledger = read_batches(spark, ledger_path)
    if ledger is None:
        raise ValueError(f"no ledger at {ledger_path}")
    current = ledger_current(ledger).select(
        "topic",
        "partition",
        decode_offset("stats", "from").alias("from_offset"),
        decode_offset("stats", "until").alias("until_offset"),
        "stats",
    )
    newest = int(ledger.agg(F.max("batch_id")).first()[0])
    if read_batches(spark, out_path) is not None:
        raise ValueError(f"{out_path} already holds a ledger")
    write_batch(current, out_path, newest, COMPACTED_RUN)


def append_cells(puts: DataFrame, cells_path: str, seq: int | None = None) -> None:
    """Append puts ``(row_key, family, qualifier, value)`` to a stored cell
    table, versioned now: ``ts`` = the current timestamp, ``seq`` = the given
    write sequence (default: the current time in microseconds), so a later
    put of the same cell wins over an earlier one."""
    stamp_seq = F.lit(seq) if seq is not None else F.unix_micros(F.current_timestamp())
    out = puts.select(
        *CELL_KEY,
        F.current_timestamp().cast("timestamp_ntz").alias("ts"),
        stamp_seq.cast("long").alias("seq"),
        F.col("value").cast("string").alias("value"),
    )
    write_batch(out, cells_path, 0, f"{manifest.PUT_PREFIX}{uuid.uuid4().hex[:12]}")


def read_cells(spark: SparkSession, cells_path: str) -> DataFrame:
    """A stored cell table (all versions), or an empty one if none exists. Files
    beside the batch folders would be passed over, so they are refused."""
    try:
        stray = spark.read.schema(CELL_SCHEMA).parquet(f"{cells_path.rstrip('/')}/*.parquet").inputFiles()
    except AnalysisException as error:
        if not is_absent(error):
            raise
    else:
        raise ValueError(f"{cells_path} holds files outside run=*/batch_id=* folders: {stray[:3]}")
    cells = read_batches(spark, cells_path, CELL_SCHEMA)
    if cells is None:
        return spark.createDataFrame([], CELL_SCHEMA)
    return cells.select(*[f.name for f in CELL_SCHEMA.fields])
