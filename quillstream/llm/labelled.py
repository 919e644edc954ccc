"""Labelled rows for fitting: folds by checksum, and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SAMPLE = 20_000  # labelled documents a classifier is fitted on, about (a documented bound)


def fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % F.lit(folds)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, max_rows: int = MAX_SAMPLE) -> DataFrame:
    """(doc_id, text, label) of labelled documents outside the held-out fold.

    Null labels and ids are left out, repeated label rows give the larger label.
    If there are more than ``max_rows`` labelled ids, a share of them is taken by
    a hash of the id, so about ``max_rows`` remain; they are few enough to broadcast.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    n = known.count()
    if n > max_rows:
        steps = 1 << 20
        known = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(label)), F.lit(steps)) < F.lit(steps * max_rows // n))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(known), "doc_id")
