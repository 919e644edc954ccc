"""Encoding of one offset range as the ledger's ``stats`` string, and back.

The string is ``topic=T;partition=P;fromOffset=F;untilOffset=U``; decoding is by
field *name* (``str_to_map``), not by position, so which offset a resume starts
from is an explicit choice (see ``operators.offsets.resume_offsets``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ledger string layout, and the short form used in range logs.
STATS_FORMAT = "topic=%s;partition=%d;fromOffset=%d;untilOffset=%d"
SHORT_FORMAT = " T=%s;P=%d;From=%d;Until=%d"
FIELD_SEPARATOR = ";"
KEY_VALUE_SEPARATOR = "="
FROM_FIELD = "fromOffset"
UNTIL_FIELD = "untilOffset"


def encode_stats(
    topic: Column | str = "topic",
    partition: Column | str = "partition",
    from_offset: Column | str = "from_offset",
    until_offset: Column | str = "until_offset",
) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in (topic, partition, from_offset, until_offset)]
    return F.format_string(STATS_FORMAT, *cols)


def encode_short(
    topic: Column | str = "topic",
    partition: Column | str = "partition",
    from_offset: Column | str = "from_offset",
    until_offset: Column | str = "until_offset",
) -> Column:
    """The short log line of a range: `` T=topic;P=partition;From=f;Until=u``."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (topic, partition, from_offset, until_offset)]
    return F.format_string(SHORT_FORMAT, *cols)


def stats_map(stats: Column | str = "stats") -> Column:
    c = F.col(stats) if isinstance(stats, str) else stats
    return F.str_to_map(c, F.lit(FIELD_SEPARATOR), F.lit(KEY_VALUE_SEPARATOR))


def stats_field(stats: Column | str, field: str) -> Column:
    return stats_map(stats)[field]


def decode_topic(stats: Column | str = "stats") -> Column:
    return stats_field(stats, "topic")


def decode_partition(stats: Column | str = "stats") -> Column:
    return stats_field(stats, "partition").cast("int")


def decode_offset(stats: Column | str = "stats", which: str = "from") -> Column:
    field = {"from": FROM_FIELD, "until": UNTIL_FIELD}[which]
    return stats_field(stats, field).cast("long")
