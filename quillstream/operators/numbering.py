"""Dense 0-based numbering of rows within keys, as a distributed sample sort.

``row_number() OVER (PARTITION BY key ORDER BY o)`` sends every row of a key to
one task. With few keys (a topic has a handful of partitions) one key can hold
a third of the data, so that plan does not scale. Instead:

1. rows are range partitioned and sorted by (key, order): Spark samples the rows
   itself and cuts at equally many rows, however ids are spread and however hot a
   key is, into as many ranges as there are shuffle partitions;
2. the ranges are checkpointed, so that the following steps see the same cuts,
   and a lost executor re-reads them;
3. a row's place is its position in its range, less the position of the first row
   of its key there, plus the rows of its key in the ranges before. Both come from
   a table of one row per (range, key), at most keys + ranges - 1 rows, built by a
   partial aggregation of positions.

Only columns that the caller passes are moved: pass keys, order and an id, and
join the numbers back to wide rows by that id. No sketch or sample of the rows
meets in one task, and no window runs over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.operators.joins import join_bounded
from quillstream.session import default_partitions, ensure_checkpoint_dir

_AT = "_qs_at"        # position: range number in the upper bits, row in the range below
_GROUP = "_qs_group"
_FIRST = "_qs_first"
_ROWS = "_qs_rows"
_BASE = "_qs_base"
_RANGE_BITS = 33      # of monotonically_increasing_id below the partition number


def segments(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(group, first position, rows of the key before): one row per (range, key)."""
    parts = placed.groupBy(_GROUP).agg(F.min(_AT).alias(_FIRST), F.count(F.lit(1)).alias(_ROWS))
    # a key's ranges only: at most one row a range, whatever the rows are
    before = Window.partitionBy(*[f"{_GROUP}.{k}" for k in keys]).orderBy(f"{_GROUP}.{_AT}").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(_GROUP, _FIRST, F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_BASE))


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    out_col: str,
    keys_bound: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = 0-based rank of each row within ``keys`` by ``order``
    (nulls first; rows that agree in keys and order are numbered in an
    unspecified order and stand in one range).

    ``keys_bound``, an upper bound on the distinct keys, lets the segment table be
    broadcast; without it the planner decides. Null keys are a key of their own.
    Runs one job (the checkpoint of the ranges).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    n = ranges or default_partitions(spark)
    ranged = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order).checkpoint()
    at = F.monotonically_increasing_id()
    # one struct column: struct equality treats null fields as equal
    placed = ranged.withColumn(_AT, at).withColumn(_GROUP, F.struct(F.shiftrightunsigned(_AT, _RANGE_BITS).alias(_AT), *[F.col(k) for k in keys]))
    bound = None if keys_bound is None else keys_bound + n
    numbered = join_bounded(placed, segments(placed, keys), [_GROUP], small_rows=bound)
    return numbered.withColumn(out_col, (F.col(_AT) - F.col(_FIRST) + F.col(_BASE)).cast("long")).drop(_GROUP, _AT, _FIRST, _BASE)
