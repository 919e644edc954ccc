"""Sliding event-time counts, on static tables and on streams.

The same function serves both. On a stream the counts are state keyed by (window,
key); a watermark bounds how long a window is kept and which rows are too late to
count. Both aggregate partially before the shuffle, so a key that holds most rows
arrives as one row per window, key and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_time(column: str) -> Column:
    """The column as a timestamp; watermarks are defined on that type only (a time
    without zone is read in the session's zone, UTC here)."""
    return F.col(column).cast("timestamp")


def sliding_count(
    events: DataFrame,
    time_col: str,
    key_col: str,
    size: str = "10 minutes",
    slide: str = "5 minutes",
    delay: str | None = None,
) -> DataFrame:
    """``(window_start, window_end, key, n)``: rows of each key in every window of
    ``size`` that starts at a multiple of ``slide``.

    A row counts in all windows ``[start, start + size)`` around its time; rows
    without a time are in no window; a null key is counted as a key of its own.
    ``delay`` is the watermark of a stream (how much later than the newest row a row
    may arrive); a static table ignores it.
    """
    timed = events.select(event_time(time_col).alias("_qs_time"), F.col(key_col).alias(key_col))
    if delay is not None and events.isStreaming:
        timed = timed.withWatermark("_qs_time", delay)
    counted = timed.groupBy(F.window("_qs_time", size, slide).alias("_qs_window"), key_col).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("_qs_window.start").alias("window_start"), F.col("_qs_window.end").alias("window_end"), key_col, "n")


def closed_windows(counted: DataFrame, watermark: Column) -> DataFrame:
    """The windows a stream with this watermark has finished: those that end at or before it."""
    return counted.where(F.col("window_end") <= watermark)
