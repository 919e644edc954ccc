"""Streaming sources over files: replay of a persisted log or of text files.

A file source records which files each micro-batch read in the stream
checkpoint, so a restarted query neither loses nor re-reads a file.
``maxFilesPerTrigger`` bounds the size of a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Newline-framed text lines (``value string``) from files appearing in
    ``path``: the replayable form of a socket text stream."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP text server (``value string``). Spark's socket source
    is not fault tolerant; use it for development only."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def write_replay_files(df: DataFrame, path: str, files: int, order_col: str) -> None:
    """Write a table as ``files`` Parquet files, each holding one contiguous
    range of ``order_col``, for stream replay."""
    df.repartitionByRange(files, order_col).sortWithinPartitions(order_col).write.mode(
        "overwrite"
    ).parquet(path)
