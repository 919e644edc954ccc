"""What a stream's checkpoint says about the query and its batches.

Spark writes the query's id into ``metadata`` when a stream first starts, and a
batch's end offsets and time into ``offsets/<batch id>`` before the batch runs.
A batch that runs again after a failure finds the same file, so what is read
here is the same on a replay. The start plan is kept beside them: it is as old
as the offsets and goes when the checkpoint goes.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from quillstream.sinks.tables import is_absent
from quillstream.sources.topiclog import SourceSpec

POSITION_SCHEMA = "topic string, partition int, position long"


@dataclass(frozen=True)
class BatchInfo:
    """Time of a batch, and (topic, partition, end offset) of every partition assigned to it."""

    time: datetime | None
    positions: tuple[tuple[str, int, int], ...]

    def positions_frame(self, spark: SparkSession) -> DataFrame | None:
        """One row per topic partition; None if the sources have no partitions."""
        return spark.createDataFrame(list(self.positions), POSITION_SCHEMA) if self.positions else None


def _lines(spark: SparkSession, path: str) -> list[str] | None:
    """Lines of a small file of the checkpoint, None if it is not there."""
    try:
        return [r.value for r in spark.read.text(path).collect()]  # one line a source
    except AnalysisException as error:
        if is_absent(error):
            return None
        raise


def _json(line: str):
    try:
        return json.loads(line)
    except ValueError:
        return None


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """Id of the streaming query that owns the checkpoint."""
    for line in _lines(spark, f"{checkpoint}/metadata") or ():
        found = _json(line)
        if isinstance(found, dict) and "id" in found:
            return found["id"]
    return None


def has_offsets(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a batch was ever planned on the checkpoint."""
    return _lines(spark, f"{checkpoint}/offsets/[0-9]*") is not None


def batch_info(spark: SparkSession, checkpoint: str, batch_id: int) -> BatchInfo | None:
    """What the offset log holds of a batch. Only sources that number their
    partitions ({topic: {partition: offset}}) give positions."""
    lines = _lines(spark, f"{checkpoint}/offsets/{int(batch_id)}")
    if lines is None:
        return None
    time, positions = None, []
    for found in filter(lambda x: isinstance(x, dict), map(_json, lines)):
        if "batchTimestampMs" in found:
            time = datetime.fromtimestamp(found["batchTimestampMs"] / 1000, timezone.utc)
        elif found and all(isinstance(v, dict) for v in found.values()):
            positions += [(t, int(p), int(o)) for t, parts in found.items() for p, o in parts.items()]
    return BatchInfo(time, tuple(sorted(positions)))


def save_start_plan(spark: SparkSession, checkpoint: str, specs: list[SourceSpec]) -> None:
    rows = [(json.dumps([asdict(s) for s in specs], sort_keys=True),)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(f"{checkpoint}/start-plan")


def load_start_plan(spark: SparkSession, checkpoint: str) -> list[SourceSpec] | None:
    lines = _lines(spark, f"{checkpoint}/start-plan")
    if not lines:
        return None
    return [SourceSpec(**{**s, "subscribe": tuple(s["subscribe"])}) for s in json.loads(lines[0])]
