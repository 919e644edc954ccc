"""Weighted rendezvous sharding of stable record keys (operator 5).

Every (key, shard) pair gets a score from a hash of both and the shard's
weight; a record goes to the shard with the highest score. A shard's scores do
not depend on the other shards, so a new shard only takes the records it wins
and a removed one only gives up its own.

Cases: a null text has size 8 and the checksum of the empty text; a null key
hashes as the empty key; equal rows go to the same shard and get different
slots; an empty table gives no rows; extra columns are kept by ``rendezvous``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.numbering import number_salted

SHARDS = 24
RECORD_OVERHEAD = 8  # bytes a record takes besides its text

# hexadecimal digits of the hash that make the uniform draw: exact in a double
DRAW_DIGITS = 13


def score(key: Column, shard: int, weight: float) -> Column:
    """``weight / -ln(u)`` with ``u`` in (0, 1) from a hash of key and shard: the
    highest of several scores falls to each shard in proportion to its weight."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{shard}")))
    draw = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("double")
    return F.lit(float(weight)) / -F.log((draw + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS)))


def rendezvous(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard", grown: float | None = None) -> DataFrame:
    """Add ``out``, the shard of each row's ``key``; with ``grown``, the weight of
    one more shard, also ``grown_<out>``: the shard once that one is there."""
    if not weights or min(weights) <= 0 or (grown is not None and grown <= 0):
        raise ValueError("shards need positive weights")
    scored = df.withColumn("_scores", F.array(*[score(F.col(key), i, w) for i, w in enumerate(weights)]))
    best = F.array_max("_scores")
    shard = (F.array_position("_scores", best) - 1).cast("int")  # ties: the lowest shard
    columns = {out: shard}
    if grown is not None:
        new = len(weights)
        columns[f"grown_{out}"] = F.when(score(F.col(key), new, grown) > best, F.lit(new)).otherwise(shard).cast("int")
    return scored.withColumns(columns).drop("_scores")


def shard_records(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard, slot within the shard and checksum of every record of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    records = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(RECORD_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = rendezvous(records, "doc_id", [1.0] * shards, grown=1.0)
    numbered = number_salted(placed, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
