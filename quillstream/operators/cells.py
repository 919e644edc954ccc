"""A keyed table of versioned cells, in long format.

Schema ``CELL_SCHEMA``: ``row_key, family, qualifier, ts, seq, value``. A cell is
(row_key, family, qualifier); each write adds a version. Versions are ordered
by ``(ts, seq)`` -- the timestamp, then the write sequence for equal
timestamps -- and a scan sees the newest version of each cell.

Writes are appends (per stream batch through ``sinks.tables.write_batch``, or
a batch of puts through ``upsert``); reads derive the newest versions with a
partially-aggregated ``max_by``, so a hot row key is combined on the map side
and never gathered into a single task. ``sinks.tables.compact_cells`` rewrites
a table to its newest versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL_KEY = ["row_key", "family", "qualifier"]
CELL_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
# The column family and qualifier the word-count sink writes.
COUNT_FAMILY = "w1"
COUNT_QUALIFIER = "total"
# Fixed value: format of the version timestamp inside a cell's key string.
KEY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def events_as_cells(events: DataFrame, family: str = COUNT_FAMILY) -> DataFrame:
    """Cells from the ``events`` table: row = user, qualifier = event type,
    version = (ts, event_id), value = the event value as text."""
    return events.select(
        F.col("user_id").cast("string").alias("row_key"),
        F.lit(family).alias("family"),
        F.col("event_type").alias("qualifier"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").cast("long").alias("seq"),
        F.col("value").cast("string").alias("value"),
    )


def counts_as_cells(
    counts: DataFrame,
    family: str = COUNT_FAMILY,
    qualifier: str = COUNT_QUALIFIER,
) -> DataFrame:
    """Word counts as cell puts: row key = word, ``family:qualifier`` = total."""
    return counts.select(
        F.col("word").alias("row_key"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        F.col("total").cast("string").alias("value"),
    )


def stamp(puts: DataFrame, ts, seq) -> DataFrame:
    """Give puts a version: ``ts`` (timestamp) and ``seq`` (write sequence)."""
    ts_col = ts if not isinstance(ts, str) else F.lit(ts)
    seq_col = seq if not isinstance(seq, int) else F.lit(seq)
    return puts.select(
        *CELL_KEY,
        ts_col.cast("timestamp_ntz").alias("ts"),
        seq_col.cast("long").alias("seq"),
        "value",
    )


def newest_cells(cells: DataFrame) -> DataFrame:
    """The newest version of every cell: ``(row_key, family, qualifier, ts, value)``."""
    newest = cells.groupBy(*CELL_KEY).agg(
        F.max_by(F.struct("ts", "value"), F.struct("ts", "seq")).alias("_qs_v")
    )
    return newest.select(*CELL_KEY, "_qs_v.ts", "_qs_v.value")


def key_values(newest: DataFrame) -> DataFrame:
    """Each cell as ``key = row/family:qualifier/timestamp`` and its value."""
    key = F.concat_ws(
        "/",
        F.col("row_key"),
        F.concat(F.col("family"), F.lit(":"), F.col("qualifier")),
        F.date_format("ts", KEY_TS_FORMAT),
    )
    return newest.select(key.alias("key"), "value")


def whole_rows(cells: DataFrame, qualifiers: Sequence[str], family: str | None = None) -> DataFrame:
    """One row per row key with one column per qualifier (newest value, null
    when the row has no such cell), in a single aggregation pass.

    Replaces a scan followed by one point read per row key. A name may be
    ``family:qualifier`` (that cell only) or a bare qualifier, which is read
    from ``family`` when given, else from any family (the newest version
    across families wins). Use ``row_maps`` when the columns are not known.
    """
    src = cells if family is None else cells.where(F.col("family") == family)
    aggs = []
    for name in qualifiers:
        fam, sep, qual = name.partition(":")
        hit = (F.col("family") == fam) & (F.col("qualifier") == qual) if sep else F.col("qualifier") == name
        aggs.append(
            F.max_by(F.when(hit, F.col("value")), F.when(hit, F.struct("ts", "seq"))).alias(name)
        )
    return src.groupBy("row_key").agg(*aggs)


def row_maps(cells: DataFrame) -> DataFrame:
    """One row per row key with a ``family:qualifier -> value`` map of its
    newest cells. The map holds one entry per cell of the row (bounded by the
    row's column count, not by its number of versions)."""
    newest = newest_cells(cells)
    entry = F.struct(F.concat(F.col("family"), F.lit(":"), F.col("qualifier")).alias("k"), F.col("value").alias("v"))
    return newest.groupBy("row_key").agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("cells")
    )


def row_strings(cells: DataFrame) -> DataFrame:
    """One row per row key with all its newest cells as one string,
    ``family:qualifier=value`` joined by ``;`` in the order of the names: whole
    rows of an open schema in one pass, whatever the number of qualifiers."""
    newest = newest_cells(cells)
    name = F.concat(F.col("family"), F.lit(":"), F.col("qualifier"))
    listed = F.array_sort(F.collect_list(F.struct(name.alias("k"), F.col("value").alias("v"))))
    text = F.transform(listed, lambda c: F.concat(c["k"], F.lit("="), F.coalesce(c["v"], F.lit(""))))
    return newest.groupBy("row_key").agg(F.array_join(text, ";").alias("cells"))


def lookup(cells: DataFrame, row_key: str) -> DataFrame:
    """Point read of one whole row (newest versions)."""
    return newest_cells(cells.where(F.col("row_key") == row_key))


def upsert(cells: DataFrame, puts: DataFrame) -> DataFrame:
    """Apply a batch of versioned puts: the table after the writes, as seen by a
    scan. A put replaces a cell only if its version is newer."""
    cols = [f.name for f in CELL_SCHEMA.fields]
    return newest_cells(cells.select(*cols).unionByName(puts.select(*cols)))
