"""Streaming: per-batch outputs, replay idempotency, resume, stream == batch,
restart on a checkpoint.

The per-batch work (``process_batch``) is exercised by handing it each batch of
the log fixture, exactly as ``foreachBatch`` would. The end-to-end stream tests
use the file source with the memory and file sinks.
"""

import json
import os
import re

from pyspark.sql import functions as F

from quillstream.operators import counts
from quillstream.operators import offsets as O
from quillstream.sinks.tables import read_batches
from quillstream.sources import topiclog as TL
from quillstream.streaming.batches import BatchOutputs, process_batch, start_plan
from quillstream.streaming.replay import text_stream

from conftest import SMOKE_DIR


def _fixture(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    return TL.documents_topic_log(docs).persist()


def _run_batches(spark, log, outputs, batch_ids):
    for b in batch_ids:
        process_batch(log.where(F.col("batch_id") == b).drop("batch_id"), b, outputs)


def test_process_batches_outputs(spark, scratch):
    log = _fixture(spark)
    last = log.agg(F.max("batch_id")).first()[0]
    out = BatchOutputs(counts=f"{scratch}/counts", ledger=f"{scratch}/ledger", cells=f"{scratch}/cells")
    _run_batches(spark, log, out, range(last + 1))

    # per-batch counts equal the batch query's counts
    msgs = log.select("batch_id", F.decode("value", "UTF-8").alias("value"))
    want = {tuple(r) for r in counts.batch_word_count(counts.tokenize(msgs, keep=["batch_id"])).collect()}
    got = {(r.batch_id, r.word, r.total) for r in read_batches(spark, out.counts).collect()}
    assert got == want

    # the ledger is dense and equals the ranges derived from the whole log
    ledger = read_batches(spark, out.ledger)
    got_ranges = {(r.batch_id, r.topic, r.partition, r.from_offset, r.until_offset) for r in ledger.collect()}
    assert got_ranges == {tuple(r) for r in O.dense_ranges(log, TL.FIXTURE_BATCH_SIZE).collect()}
    assert all(r.stats.startswith(f"topic={r.topic};partition={r.partition};") for r in ledger.collect())

    # the newest cell of a word holds its count in the last batch that had it
    cells = spark.read.parquet(out.cells)
    newest = {r.row_key: r.value for r in
              cells.groupBy("row_key").agg(F.max_by("value", F.struct("ts", "seq")).alias("value")).collect()}
    last_count = {}
    for b, w, n in sorted(want):
        last_count[w] = str(n)
    assert newest == last_count


def test_replayed_batch_replaces_itself(spark, scratch):
    log = _fixture(spark)
    out = BatchOutputs(counts=f"{scratch}/counts", ledger=f"{scratch}/ledger")
    _run_batches(spark, log, out, [0, 1, 2])
    before_counts = sorted(map(tuple, read_batches(spark, out.counts).collect()))
    before_ledger = sorted(map(tuple, read_batches(spark, out.ledger).collect()))
    _run_batches(spark, log, out, [2])  # the batch runs again after a failure
    assert sorted(map(tuple, read_batches(spark, out.counts).collect())) == before_counts
    assert sorted(map(tuple, read_batches(spark, out.ledger).collect())) == before_ledger


def test_resume_from_ledger(spark, scratch):
    log = _fixture(spark)
    out = BatchOutputs(ledger=f"{scratch}/ledger")
    topics = sorted(r.topic for r in log.select("topic").distinct().collect())
    (fresh,) = start_plan(spark, out.ledger, topics)
    assert fresh.starting_offsets == "latest"
    _run_batches(spark, log, out, [0, 1])
    start_from = json.loads(start_plan(spark, out.ledger, topics)[0].starting_offsets)
    start_until = json.loads(start_plan(spark, out.ledger, topics, which="until")[0].starting_offsets)
    ends = {(r.topic, r.partition): r.end_offset for r in O.partition_ends(log).collect()}
    for (t, p), e in ends.items():
        assert start_from[t][str(p)] == min(10, e)      # replays batch 1
        assert start_until[t][str(p)] == min(20, e)     # continues after it
    # resuming with "from" replays exactly the last recorded batch
    starts = O.resume_offsets(O.ledger_current(read_batches(spark, out.ledger)), "from")
    resumed = O.resume_messages(log.where("batch_id <= 1"), starts, partitions_bound=len(ends))
    assert resumed.count() == log.where("batch_id = 1").count()
    # with "until" nothing that was already recorded is read again
    after = O.resume_offsets(O.ledger_current(read_batches(spark, out.ledger)), "until")
    assert O.resume_messages(log.where("batch_id <= 1"), after, partitions_bound=len(ends)).count() == 0


def _write_texts(spark, docs, path, files):
    """``files`` text files (one per doc_id range) appended to ``path``."""
    ranged = docs.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    ranged.select(F.col("text").alias("value")).write.mode("append").text(path)


def test_stream_equals_batch(spark, scratch):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    src = f"{scratch}/lines"
    _write_texts(spark, docs, src, 3)
    stream = counts.tokenize(text_stream(spark, src, max_files_per_trigger=1))
    q = (stream.writeStream.format("memory").queryName("qs_tokens")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert len(batches) >= 3
    got = spark.table("qs_tokens").groupBy("word").count()
    want = counts.tokenize(spark.read.text(src)).groupBy("word").count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_restart_on_checkpoint(spark, scratch):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    src, sink, ck = f"{scratch}/lines", f"{scratch}/tokens", f"{scratch}/ck"
    _write_texts(spark, docs.where("doc_id < 100"), src, 2)

    def run():
        stream = counts.tokenize(text_stream(spark, src, max_files_per_trigger=1))
        q = (stream.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(300)

    run()
    first = spark.read.parquet(sink).count()
    _write_texts(spark, docs.where("doc_id >= 100"), src + "_more", 1)
    spark.read.text(src + "_more").write.mode("append").text(src)
    run()
    got = spark.read.parquet(sink).groupBy("word").count()
    want = counts.tokenize(spark.read.text(src)).groupBy("word").count()
    assert spark.read.parquet(sink).count() > first
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert os.path.isdir(os.path.join(ck, "commits"))


def test_topic_log_replay_stream(spark, scratch):
    """A log persisted partitioned by topic, replayed as a stream with a
    subscription: only the subscribed topics arrive, values decode to text."""
    log = _fixture(spark).drop("batch_id")
    path = f"{scratch}/log"
    TL.write_topic_log(log, path, mode="overwrite")
    batch = TL.read_topic_log(spark, path, topics="en,de")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    # the subscription prunes topic directories instead of filtering rows
    assert re.search(r"PartitionFilters: \[[^\]]*topic", plan) and "PushedFilters: []" in plan
    stream = TL.message_values(TL.topic_log_stream(spark, path, topics="en,de", max_files_per_trigger=2))
    q = (stream.writeStream.format("memory").queryName("qs_log_replay")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("qs_log_replay")
    want = TL.message_values(TL.subscribe(log, ["en", "de"]))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_show_rows_prints_top_counts(spark, scratch, capsys):
    df = spark.createDataFrame([("b a a",)], "value string")
    process_batch(df, 7, BatchOutputs(show_rows=2))
    out = capsys.readouterr().out
    assert "=== batch 7 at " in out and "|a   |2    |" in out


def test_new_run_keeps_earlier_ledger(spark, scratch):
    """A stream resumed on a new checkpoint restarts its batch ids at 0; its
    ledger rows go to a new run and the positions carry across runs."""
    log = _fixture(spark)
    first = BatchOutputs(ledger=f"{scratch}/ledger", run="rA")
    _run_batches(spark, log, first, [0, 1, 2])
    # second run: batch ids restart, and it reads only one topic's messages
    second = BatchOutputs(ledger=f"{scratch}/ledger", run="rB")
    process_batch(log.where("batch_id = 3 AND topic = 'en'").drop("batch_id"), 0, second)
    ledger = read_batches(spark, f"{scratch}/ledger")
    assert {r.run for r in ledger.collect()} == {"rA", "rB"}
    assert ledger.where("run = 'rA'").select("batch_id").distinct().count() == 3
    current = {(r.topic, r.partition): r.stats for r in O.ledger_current(ledger).collect()}
    whole = {(r.topic, r.partition): r.stats for r in
             O.ledger_current(O.ledger_rows(O.dense_ranges(log.where("batch_id <= 3"), 10))).collect()}
    en = {k: v for k, v in whole.items() if k[0] == "en"}
    assert {k: v for k, v in current.items() if k[0] == "en"} == en
    # other topics: carried from run A's last batch as empty ranges at its end
    rb = {(r.topic, r.partition): (r.from_offset, r.until_offset) for r in ledger.where("run = 'rB'").collect()}
    ra_last = {(r.topic, r.partition): r.until_offset for r in ledger.where("run = 'rA' AND batch_id = 2").collect()}
    for k, until in ra_last.items():
        if k[0] != "en":
            assert rb[k] == (until, until)


def test_start_plan_sources(spark, scratch):

    ledger = f"{scratch}/ledger"
    assert [(s.starting_offsets, s.assign, s.subscribe) for s in start_plan(spark, ledger, ["a", "b"])] == [
        ("latest", None, ("a", "b"))
    ]
    out = BatchOutputs(ledger=ledger)
    batch = spark.createDataFrame([("a", 0, 5), ("a", 1, 7), ("c", 0, 1)], "topic string, partition int, offset long")
    process_batch(batch, 0, out)
    specs = start_plan(spark, ledger, ["a", "b"])
    assert len(specs) == 2
    assert specs[0].assign is None and specs[0].subscribe == ("a",)
    assert json.loads(specs[0].starting_offsets) == {"a": {"0": 5, "1": 7}}
    assert (specs[1].starting_offsets, specs[1].subscribe) == ("latest", ("b",))
    strict = start_plan(spark, ledger, ["a", "b"], strict_ledger=True, which="until")
    assert len(strict) == 1 and json.loads(strict[0].assign) == {"a": [0, 1], "c": [0]}
    assert json.loads(strict[0].starting_offsets) == {"a": {"0": 6, "1": 8}, "c": {"0": 2}}


def test_stream_wiring_without_callback(spark, scratch, monkeypatch):
    """``start_word_count_stream`` wiring: checkpoint under the session's
    ``spark.checkpoint.dir``, run label derived from it, trigger passed through.
    ``foreachBatch`` is swapped for the noop sink (so no Python callback is
    needed) and the captured function is then handed a batch directly."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    from quillstream.session import shared_dir
    from quillstream.sinks.tables import run_label
    from quillstream.streaming.batches import start_word_count_stream
    from quillstream.streaming.checkpoints import batch_info, query_id

    captured = {}

    def fake_foreach_batch(self, fn):
        captured["fn"] = fn
        return self.format("noop")

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", fake_foreach_batch)
    src = f"{scratch}/lines"
    spark.createDataFrame([("a b",), ("b",)], "value string").write.text(src)
    out = BatchOutputs(counts=f"{scratch}/counts")
    # the session's checkpoint folder outlives this test: use a fresh stream name
    name = f"qs_wiring_{os.path.basename(scratch)}"
    q = start_word_count_stream(text_stream(spark, src), out, name, trigger={"availableNow": True})
    q.awaitTermination(120)
    location = shared_dir(spark, "streams", name)
    assert os.path.isdir(location.replace("file:", "") + "/commits")
    captured["fn"](spark.read.text(src), 0)
    got = read_batches(spark, out.counts)
    assert query_id(spark, location) == str(q.id)
    assert {r.run for r in got.collect()} == {run_label(str(q.id))}
    # the batch's time is the stream's, and the same when the batch runs again
    times = {r.batch_time for r in got.select(F.unix_millis("batch_time").alias("batch_time")).collect()}
    assert times == {round(batch_info(spark, location, 0).time.timestamp() * 1000)}
    captured["fn"](spark.read.text(src), 0)
    again = read_batches(spark, out.counts)
    assert {r.batch_time for r in again.select(F.unix_millis("batch_time").alias("batch_time")).collect()} == times
    assert {(r.word, r.total) for r in again.collect()} == {("a", 1), ("b", 2)}


def test_app_dry_run(spark, scratch, capsys):
    from quillstream.streaming import app

    base = f"{scratch}/base"
    assert app.main(["b:9092", "test,test2", base, "--dry-run"], spark=spark) == 0
    fresh = json.loads(capsys.readouterr().out)
    assert fresh["sources"] == [{"assign": None, "starting_offsets": "latest", "subscribe": ["test", "test2"]}]
    batch = spark.createDataFrame([("test", 0, 3, "x y")], "topic string, partition int, offset long, value string")
    process_batch(batch, 0, BatchOutputs(ledger=f"{base}/ledger"))
    assert app.main(["b:9092", "test,test2", base, "--dry-run", "--resume", "until"], spark=spark) == 0
    resumed = json.loads(capsys.readouterr().out)["sources"]
    assert json.loads(resumed[0]["starting_offsets"]) == {"test": {"0": 4}}
    assert resumed[1]["subscribe"] == ["test2"]


def test_compact_ledger_resumes_identically(spark, scratch):
    from quillstream.sinks.tables import compact_ledger

    log = _fixture(spark)
    out = BatchOutputs(ledger=f"{scratch}/ledger")
    _run_batches(spark, log, out, [0, 1, 2, 3])
    compact_ledger(spark, out.ledger, f"{scratch}/compact")
    topics = sorted(r.topic for r in log.select("topic").distinct().collect())
    for which in ("from", "until"):
        full = start_plan(spark, out.ledger, topics, which=which)
        small = start_plan(spark, f"{scratch}/compact", topics, which=which)
        assert [json.loads(s.starting_offsets) for s in full] == [json.loads(s.starting_offsets) for s in small]
    compacted = read_batches(spark, f"{scratch}/compact")
    assert compacted.count() == O.partition_ends(log).count()
    assert {r.batch_id for r in compacted.collect()} == {3}


def test_write_replay_files(spark, scratch):
    from quillstream.sources.tables import read_lines
    from quillstream.streaming.replay import write_replay_files

    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text")
    write_replay_files(docs, f"{scratch}/replay", 4, "doc_id")
    files = [f for f in os.listdir(f"{scratch}/replay") if f.endswith(".parquet")]
    assert len(files) == 4
    back = spark.read.parquet(f"{scratch}/replay")
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0
    # many files as one line dataset, with the source file of every line
    spark.read.parquet(f"{scratch}/replay").select("text").write.text(f"{scratch}/txt")
    lines = read_lines(spark, f"{scratch}/txt").select("value", "_metadata.file_path")
    assert lines.select("file_path").distinct().count() >= 1
    assert lines.count() == counts.frame(spark.read.text(f"{scratch}/txt")).count()


def test_log_ranges(spark, caplog):
    import logging

    batch = spark.createDataFrame([("DomainTest", 0, 1), ("DomainTest", 2, 2), ("DomainTest", 2, 3)],
                                  "topic string, partition int, offset long")
    with caplog.at_level(logging.INFO, logger="quillstream.offsets"):
        process_batch(batch, 5, BatchOutputs(log_ranges=True))
    assert [r.getMessage() for r in caplog.records] == [
        "batch 5: T=DomainTest;P=0;From=1;Until=2",
        "batch 5: T=DomainTest;P=2;From=2;Until=4",
    ]


def test_kafka_sources_options(spark, scratch, monkeypatch):
    """The Kafka shim without the connector jar: options are recorded and
    ``load`` is replaced by an empty Parquet stream with the Kafka columns."""
    from pyspark.sql.streaming.readwriter import DataStreamReader

    calls = []
    real_option = DataStreamReader.option

    def record_option(self, key, value):
        calls[-1][key] = value
        return real_option(self, key, value)

    def record_format(self, source):
        calls.append({"format": source})
        return self

    empty = f"{scratch}/empty"
    os.makedirs(empty)
    monkeypatch.setattr(DataStreamReader, "format", record_format)
    monkeypatch.setattr(DataStreamReader, "option", record_option)
    monkeypatch.setattr(DataStreamReader, "load", lambda self: spark.readStream.schema(TL.LOG_SCHEMA).parquet(empty))

    specs = [
        TL.SourceSpec('{"a": {"0": 5}}', assign='{"a": [0]}'),
        TL.SourceSpec("latest", subscribe=("b", "c")),
    ]
    log = TL.open_sources(spark, "h1:9092,h2:9092", specs, max_offsets_per_trigger=1000)
    assert log.isStreaming and log.columns == [f.name for f in TL.LOG_SCHEMA.fields]
    kafka = [c for c in calls if c.get("format") == "kafka"]
    assert kafka[0]["assign"] == '{"a": [0]}' and kafka[0]["startingOffsets"] == '{"a": {"0": 5}}'
    assert "subscribe" not in kafka[0]
    assert kafka[1]["subscribe"] == "b,c" and kafka[1]["startingOffsets"] == "latest"
    assert all(c["kafka.bootstrap.servers"] == "h1:9092,h2:9092" and c["maxOffsetsPerTrigger"] == "1000" for c in kafka)


def test_app_replay_runs_to_completion(spark, scratch, monkeypatch):
    """The CLI's run path on a replayed Parquet log with --available-now
    (foreachBatch swapped for the noop sink, as in the wiring test)."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    from quillstream.streaming import app

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", lambda self, fn: self.format("noop"))
    log = _fixture(spark).drop("batch_id")
    TL.write_topic_log(log, f"{scratch}/log", mode="overwrite")
    ck = f"{scratch}/ck"
    rc = app.main(["-", "en,de", f"{scratch}/base", "--replay-log", f"{scratch}/log",
                   "--available-now", "--checkpoint", ck], spark=spark)
    assert rc == 0
    assert os.path.isdir(os.path.join(ck, "commits")) and os.listdir(os.path.join(ck, "commits"))


def test_kafka_fails_on_data_loss_by_default(spark, monkeypatch):
    from pyspark.sql.streaming.readwriter import DataStreamReader

    seen = {}
    real_option = DataStreamReader.option

    def record(self, key, value):
        seen[key] = value
        return real_option(self, key, value)

    monkeypatch.setattr(DataStreamReader, "option", record)
    monkeypatch.setattr(DataStreamReader, "load", lambda self: (_ for _ in ()).throw(RuntimeError("stop")))
    try:
        TL.kafka_stream(spark, "h:9092", "a")
    except RuntimeError:
        pass
    assert seen["failOnDataLoss"] == "true" and seen["subscribe"] == "a"


def test_ledger_batch_is_one_file(spark, scratch):
    log = _fixture(spark)
    out = BatchOutputs(ledger=f"{scratch}/ledger")
    _run_batches(spark, log, out, [0])
    d = f"{scratch}/ledger/run=default/batch_id=0"
    assert len([f for f in os.listdir(d) if f.endswith(".parquet")]) == 1


def test_batch_persisted_only_when_shared(spark, scratch, monkeypatch):
    batch = spark.createDataFrame([("t", 0, 1, "a b")], "topic string, partition int, offset long, value string")
    cls = type(batch)  # the concrete (classic) DataFrame class
    calls = []
    real = cls.persist

    def counting(self, *a, **k):
        calls.append(tuple(self.columns))
        return real(self, *a, **k)

    monkeypatch.setattr(cls, "persist", counting)
    process_batch(batch, 0, BatchOutputs(counts=f"{scratch}/c1"))
    assert tuple(batch.columns) not in calls          # one reader: no persist of the batch
    process_batch(batch, 0, BatchOutputs(counts=f"{scratch}/c2", ledger=f"{scratch}/l2"))
    assert tuple(batch.columns) in calls              # ranges and counts: read once


def _offset_log(checkpoint, batch_id, positions, time_ms=1_700_000_000_000):
    """What a stream writes before a batch: version, metadata, one line a source."""
    os.makedirs(f"{checkpoint}/offsets", exist_ok=True)
    with open(f"{checkpoint}/offsets/{batch_id}", "w") as f:
        f.write("v1\n" + json.dumps({"batchWatermarkMs": 0, "batchTimestampMs": time_ms, "conf": {}}) + "\n" + json.dumps(positions))


def test_every_assigned_partition_is_recorded_logged_and_resumed(spark, scratch, caplog):
    """The sample of three empty ranges, from a batch that reads nothing."""
    import logging

    ck = f"{scratch}/ck"
    _offset_log(ck, 0, {"DomainTest": {"0": 1, "1": 2, "2": 2}})
    none = spark.createDataFrame([], "topic string, partition int, offset long, value string")
    out = BatchOutputs(ledger=f"{scratch}/ledger", log_ranges=True, checkpoint=ck)
    with caplog.at_level(logging.INFO, logger="quillstream.offsets"):
        process_batch(none, 0, out)
    assert [r.getMessage() for r in caplog.records] == [
        f"batch 0: T=DomainTest;P={p};From={o};Until={o}" for p, o in [(0, 1), (1, 2), (2, 2)]
    ]
    # later, partition 2 stays quiet and partition 3 is new
    _offset_log(ck, 1, {"DomainTest": {"0": 3, "1": 2, "2": 2, "3": 0}})
    process_batch(spark.createDataFrame([("DomainTest", 0, 1, "a"), ("DomainTest", 0, 2, "b")], none.schema), 1, out)
    ledger = read_batches(spark, out.ledger).where("batch_id = 1")
    assert {(r.partition, r.from_offset, r.until_offset) for r in ledger.collect()} == {(0, 1, 3), (1, 2, 2), (2, 2, 2), (3, 0, 0)}
    (spec,) = start_plan(spark, out.ledger, ["DomainTest"], which="until")
    assert json.loads(spec.starting_offsets) == {"DomainTest": {"0": 3, "1": 2, "2": 2, "3": 0}}
    # a partition added while the stream was down is read from its beginning; not
    # listed, Kafka refuses to subscribe with this JSON and names the partition
    (spec,) = start_plan(spark, out.ledger, ["DomainTest"], which="until", partitions={"DomainTest": range(5)})
    assert json.loads(spec.starting_offsets)["DomainTest"]["4"] == TL.EARLIEST
    assert spec.assign is None and spec.subscribe == ("DomainTest",)


def test_recreated_checkpoint_keeps_the_old_run(spark, scratch, monkeypatch):
    """The checkpoint folder is replaced by a new one at the same path: the old
    batches stay and every partition can be resumed."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    from quillstream.streaming.batches import start_word_count_stream

    captured = {}

    def fake_foreach_batch(self, fn):
        captured["fn"] = fn
        return self.format("noop")

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", fake_foreach_batch)
    src, ck = f"{scratch}/lines", f"{scratch}/ck"
    spark.createDataFrame([("a",)], "value string").write.text(src)
    out = BatchOutputs(counts=f"{scratch}/counts", ledger=f"{scratch}/ledger", cells=f"{scratch}/cells")
    schema = "topic string, partition int, offset long, value string"
    for batch in ([("t", 0, 0, "old"), ("t", 1, 4, "old")], [("t", 0, 1, "new")]):
        start_word_count_stream(text_stream(spark, src), out, "qs_recreated", ck, {"availableNow": True}).awaitTermination(120)
        captured["fn"](spark.createDataFrame(batch, schema), 0)
        os.replace(ck, f"{ck}-{len(batch)}")  # the next stream finds no checkpoint there
    ledger = read_batches(spark, out.ledger)
    assert ledger.select("run").distinct().count() == 2
    (spec,) = start_plan(spark, out.ledger, ["t"], which="until")
    assert json.loads(spec.starting_offsets) == {"t": {"0": 2, "1": 5}}
    assert {(r.word, r.total) for r in read_batches(spark, out.counts).collect()} == {("old", 2), ("new", 1)}


def test_unreadable_ledger_raises(spark, scratch):
    import pytest

    assert read_batches(spark, f"{scratch}/none") is None
    os.makedirs(f"{scratch}/ledger/run=r1/batch_id=0")
    with open(f"{scratch}/ledger/run=r1/batch_id=0/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        start_plan(spark, f"{scratch}/ledger", ["t"])


def test_two_sources_restart_with_the_stored_plan(spark, scratch, monkeypatch):
    """A resume opens two sources. By the restart the ledger knows both topics and
    would open one; the plan kept with the checkpoint still opens two."""
    import pytest
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    from quillstream.streaming import app

    base, ck = f"{scratch}/base", f"{scratch}/ck"
    monkeypatch.setattr(DataStreamWriter, "foreachBatch", lambda self, fn: self.format("noop"))
    opened = []

    def open_files(session, brokers, specs, **options):
        opened.append(len(specs))
        frames = [session.readStream.schema("value string").text(f"{scratch}/in{i}") for i, _ in enumerate(specs)]
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    monkeypatch.setattr(app, "open_sources", open_files)
    for i in (0, 1):
        spark.createDataFrame([(f"w{i}",)], "value string").write.text(f"{scratch}/in{i}")
    process_batch(spark.createDataFrame([("a", 0, 5)], "topic string, partition int, offset long"), 0, BatchOutputs(ledger=f"{base}/ledger", run="r0"))
    args = ["h:1", "a,b", base, "--checkpoint", ck, "--available-now"]
    assert app.main(args, spark=spark) == 0
    process_batch(spark.createDataFrame([("b", 0, 1)], "topic string, partition int, offset long"), 1, BatchOutputs(ledger=f"{base}/ledger", run="r0"))
    assert len(start_plan(spark, f"{base}/ledger", ["a", "b"])) == 1
    assert app.main(args, spark=spark) == 0
    assert opened == [2, 2]
    with pytest.raises(SystemExit, match="new --checkpoint"):
        app.main([*args, "--from-ledger"], spark=spark)
    # a new checkpoint resumes from the ledger
    assert app.main(["h:1", "a,b", base, "--checkpoint", f"{scratch}/ck2", "--available-now", "--from-ledger"], spark=spark) == 0
    assert opened == [2, 2, 1]


def test_lines_program(spark, scratch, monkeypatch, capsys):
    """Text lines counted per batch from the command line, with a time header."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    from quillstream.streaming import app

    captured = {}

    def fake_foreach_batch(self, fn):
        captured["fn"] = fn
        return self.format("noop")

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", fake_foreach_batch)
    spark.createDataFrame([("a b",), ("b",)], "value string").coalesce(1).write.text(f"{scratch}/in")
    args = ["-", "lines", f"{scratch}/base", "--lines-dir", f"{scratch}/in", "--checkpoint", f"{scratch}/ck", "--no-cells", "--available-now"]
    assert app.parse_args(args).interval == 1.0
    assert app.main(args, spark=spark) == 0
    captured["fn"](spark.read.text(f"{scratch}/in"), 0)
    assert "=== batch 0 at 20" in capsys.readouterr().out
    got = read_batches(spark, f"{scratch}/base/counts")
    assert {(r.word, r.total) for r in got.collect()} == {("a", 1), ("b", 2)}
    assert app.parse_args(["-", "lines", "b", "--lines", "localhost:9999"]).address == ("localhost", 9999)


def test_no_master_is_set_by_default(monkeypatch):
    from pyspark.sql import SparkSession

    from quillstream import session

    seen = {}

    class Builder:
        def appName(self, name):
            return self

        def config(self, key, value):
            return self

        def master(self, master):
            seen["master"] = master
            return self

        def getOrCreate(self):
            raise RuntimeError("stop")

    monkeypatch.setattr(SparkSession, "builder", Builder())
    for master in (None, "local[3]"):
        try:
            session.build_session(master)
        except RuntimeError:
            pass
        assert seen.get("master") == master
