"""Streaming sliding-window counts into a table of finished windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quillstream.operators.windows import sliding_count
from quillstream.session import shared_dir


def start_sliding_count_stream(
    events: DataFrame,
    path: str,
    name: str,
    time_col: str,
    key_col: str,
    size: str = "10 minutes",
    slide: str = "5 minutes",
    delay: str = "10 minutes",
    trigger: dict | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Append each window to ``path`` (Parquet) once, when the watermark passes its end.

    Rows later than ``delay`` after the newest row of the batches before are not
    counted. State holds the open windows only. After a restart on the same
    checkpoint the windows, their counts and the watermark go on where they were; a
    window is never written twice. The default checkpoint is in the shared folder.
    """
    counted = sliding_count(events, time_col, key_col, size, slide, delay)
    writer = (
        counted.writeStream.queryName(name).outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint or shared_dir(events.sparkSession, "streams", name))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
