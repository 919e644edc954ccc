"""Gapless numbers within groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.session import default_partitions


def number_salted(df: DataFrame, group: str, order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: 0 .. n - 1 within each value of ``group``, gapless.

    Rows are ranked inside (group, salt) by ``order``; the salt is a hash of the
    order columns, so a group that holds most rows is spread over as many tasks
    as there are shuffle partitions. The rows before each salt come from counts
    per (group, salt). Rows that agree in all order columns are interchangeable.
    """
    salts = max(16, default_partitions(df.sparkSession))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    # one struct: null groups are equal to each other and survive the join
    salted = salted.withColumn("_gs", F.struct(F.col(group).alias("g"), F.col("_salt").alias("s")))
    before = Window.partitionBy("_gs.g").orderBy("_gs.s").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        salted.groupBy("_gs").agg(F.count(F.lit(1)).alias("_n"))
        .select("_gs", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy("_gs").orderBy(*order)
    ranked = salted.withColumn("_rank", F.row_number().over(inside))
    return (
        ranked.join(bases, "_gs")
        .withColumn(out, (F.col("_base") + F.col("_rank") - 1).cast("long"))
        .drop("_gs", "_salt", "_rank", "_base")
    )
