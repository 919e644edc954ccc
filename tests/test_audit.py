"""The ledger against the query's own progress."""

import json

from quillstream.operators import offsets as O
from quillstream.sinks.tables import read_batches, write_batch
from quillstream.streaming import audit


def _progress(batch, start, end):
    source = {"description": "log", "startOffset": start, "endOffset": end, "numInputRows": 1}
    return {"batchId": batch, "numInputRows": 1, "sources": [source]}


PROGRESS = [
    _progress(0, None, {"a": {"0": 10, "1": 3}}),
    _progress(1, {"a": {"0": 10, "1": 3}}, {"a": {"0": 20, "1": 3}}),
    json.dumps(_progress(1, {"a": {"0": 10, "1": 3}}, {"a": {"0": 10, "1": 3}})),
    _progress(2, {"a": {"0": 20, "1": 3}}, {"a": {"0": 27, "1": 3}, "b": {"0": 4}}),
    _progress(3, {"a": {"0": 27, "1": 3}, "b": {"0": 4}}, {"a": {"0": 27, "1": 3}, "b": {"0": 4}}),
]
LEDGER = [
    (0, "a", 0, 0, 10), (0, "a", 1, 0, 3),
    (1, "a", 0, 10, 20), (1, "a", 1, 3, 3),
    (2, "a", 0, 20, 27), (2, "a", 1, 3, 3), (2, "b", 0, 1, 4),
]


def _ranges(spark, rows):
    return spark.createDataFrame(rows, "batch_id long, topic string, partition int, from_offset long, until_offset long")


def _findings(spark, rows):
    found = audit.audit_ledger(_ranges(spark, rows), audit.progress_frame(spark, PROGRESS))
    return {(r.batch_id, r.topic, r.partition, r.problem) for r in found.collect()}


def test_progress_ranges(spark):
    got = audit.progress_ranges(audit.progress_frame(spark, PROGRESS)).collect()
    assert {tuple(r) for r in got} == {
        (0, "a", 0, None, 10), (0, "a", 1, None, 3), (1, "a", 0, 10, 20), (1, "a", 1, 3, 3),
        (2, "a", 0, 20, 27), (2, "a", 1, 3, 3), (2, "b", 0, None, 4),
        (3, "a", 0, 27, 27), (3, "a", 1, 3, 3), (3, "b", 0, 4, 4),
    }


def test_a_whole_ledger_has_no_findings(spark):
    assert _findings(spark, LEDGER) == set()
    assert _findings(spark, LEDGER + [(9, "a", 0, 90, 99)]) == set()  # not reported any more


def test_a_dropped_batch_is_reported(spark, scratch):
    for batch in (0, 2):  # batch 1 was never written
        rows = _ranges(spark, [r for r in LEDGER if r[0] == batch])
        write_batch(O.ledger_rows(rows), f"{scratch}/ledger", batch)
    stored = read_batches(spark, f"{scratch}/ledger")
    found = audit.audit_ledger(stored, audit.progress_frame(spark, PROGRESS)).collect()
    assert [(r.batch_id, r.topic, r.partition, r.problem, r.progress_from, r.progress_until) for r in found] == [(1, "a", 0, "missing", 10, 20)]


def test_ranges_that_were_not_read(spark):
    rows = [r for r in LEDGER if r[:3] != (1, "a", 0)] + [(1, "a", 0, 10, 21), (2, "c", 0, 0, 5)]
    assert _findings(spark, rows) == {(1, "a", 0, "outside"), (2, "c", 0, "unread")}
    assert _findings(spark, [(b, t, p, f, u - (t == "b")) for b, t, p, f, u in LEDGER]) == set()  # a gap at the end


def test_sources_without_partitions_are_passed_over(spark, scratch):
    spark.range(3).selectExpr("cast(id as string) as value").write.text(f"{scratch}/in")
    query = (
        spark.readStream.text(f"{scratch}/in").writeStream.format("noop")
        .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.recentProgress and audit.progress_ranges(audit.progress_frame(spark, query.recentProgress)).count() == 0
