"""Readers for the Parquet tables the jobs run on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException

from quillstream.session import parallelism


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(
    spark: SparkSession, base_dir: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Read one table; selecting ``columns`` up front keeps the Parquet
    ``ReadSchema`` narrow even before Catalyst prunes."""
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, by: Sequence[str] = (), min_partitions: int | None = None) -> DataFrame:
    """Hash-redistribute ``df`` only when its scan yields fewer partitions than
    the cluster has cores (e.g. one unsplittable Parquet row group).

    On a large input the scan is already wide and this is a no-op, so it never
    adds a shuffle of the full data at scale. Partitioning by ``by`` (hash)
    keeps the result deterministic on retry.
    """
    target = min_partitions or parallelism(df.sparkSession)
    try:
        current = df.rdd.getNumPartitions()  # plans the scan; runs no job
    except Exception:  # no RDD access in this client: leave it to the scan
        return df
    if current >= target:
        return df
    return df.repartition(target, *by) if by else df.repartition(target)


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Line-delimited text from one or many files/globs as one DataFrame
    (``value string``); the file each line came from is available through the
    hidden ``_metadata.file_path`` column."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths))


def table_available(spark: SparkSession, name_or_path: str) -> bool:
    """Is the table there? A catalog name is looked up in the catalog; a path
    (containing ``/``) counts as available when Spark can resolve it as a
    Parquet table. Nothing is scanned."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    try:
        spark.read.parquet(name_or_path).schema
        return True
    except AnalysisException:
        return False
