"""Offset ranges, ledger codec, resume and the fixture log."""

import re

from pyspark.sql import functions as F

from quillstream.functions.ledger_codec import decode_offset, decode_partition, decode_topic, encode_stats
from quillstream.operators import offsets as O
from quillstream.sources import topiclog as TL

from conftest import SMOKE_DIR


def _log(spark, ends):
    rows = [(t, p, o) for (t, p), e in ends.items() for o in range(e)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long")


def test_dense_ranges_brute_force(spark):
    ends = {("a", 0): 25, ("a", 1): 3, ("b", 0): 10, ("b", 2): 0 + 1}
    got = O.dense_ranges(_log(spark, ends), 10).collect()
    last = max((e - 1) // 10 for e in ends.values())
    want = {
        (b, t, p, min(b * 10, e), min((b + 1) * 10, e))
        for (t, p), e in ends.items()
        for b in range(last + 1)
    }
    assert {tuple(r) for r in got} == want
    assert len(got) == len(want)


def test_dense_ranges_many_chunks(spark):
    # more batches than one generation chunk
    ends = {("t", 0): 5 * (O.BATCH_CHUNK + 3), ("t", 1): 7}
    rows = O.dense_ranges(_log(spark, ends), 5).where(F.col("partition") == 1).collect()
    assert len(rows) == O.BATCH_CHUNK + 3
    assert sorted(r.batch_id for r in rows) == list(range(O.BATCH_CHUNK + 3))
    empty = [r for r in rows if r.from_offset == r.until_offset]
    assert len(empty) == O.BATCH_CHUNK + 3 - 2 and all(r.from_offset == 7 for r in empty)


def test_last_ranges_are_the_last_of_the_dense_ones(spark):
    ends = {("a", 0): 25, ("a", 1): 3, ("b", 0): 10, ("b", 2): 1}
    frame = O.partition_ends(_log(spark, ends))
    last = {tuple(r) for r in O.last_ranges(frame, 10).collect()}
    assert last == {tuple(r) for r in O.ranges_of_ends(frame, 10).where("batch_id = 2").collect()} and len(last) == 4
    none = spark.createDataFrame([], "topic string, partition int, end_offset long")
    assert O.last_ranges(none, 10).count() == 0 and O.ranges_of_ends(none, 10).count() == 0


def test_fixture_ends_are_the_logs(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    want = {tuple(r) for r in O.partition_ends(TL.documents_topic_log(docs)).collect()}
    assert {tuple(r) for r in TL.fixture_ends(docs).collect()} == want


def test_stats_roundtrip_and_golden(spark):
    # sample output of the reference: topic DomainTest, three empty ranges
    golden = [("DomainTest", 0, 1, 1), ("DomainTest", 2, 2, 2), ("DomainTest", 1, 2, 2)]
    df = spark.createDataFrame(golden, "topic string, partition int, from_offset long, until_offset long")
    enc = df.select(encode_stats().alias("stats"))
    out = enc.select(
        "stats",
        decode_topic().alias("t"),
        decode_partition().alias("p"),
        decode_offset("stats", "from").alias("f"),
        decode_offset("stats", "until").alias("u"),
    ).collect()
    assert out[0].stats == "topic=DomainTest;partition=0;fromOffset=1;untilOffset=1"
    assert [(r.t, r.p, r.f, r.u) for r in out] == golden


def test_ledger_current_and_resume(spark):
    ranges = spark.createDataFrame(
        [(0, "a", 0, 0, 10), (1, "a", 0, 10, 20), (1, "a", 1, 0, 5), (2, "a", 1, 5, 5), (2, "a", 0, 20, 20)],
        "batch_id long, topic string, partition int, from_offset long, until_offset long",
    )
    current = O.ledger_current(O.ledger_rows(ranges))
    got = {(r.topic, r.partition): (r.batch_id, r.stats) for r in current.collect()}
    assert got[("a", 0)] == (2, "topic=a;partition=0;fromOffset=20;untilOffset=20")
    starts_from = {(r.topic, r.partition): r.start_offset for r in O.resume_offsets(current, "from").collect()}
    starts_until = {(r.topic, r.partition): r.start_offset for r in O.resume_offsets(current, "until").collect()}
    assert starts_from == {("a", 0): 20, ("a", 1): 5}
    assert starts_until == {("a", 0): 20, ("a", 1): 5}
    # replaying the same batch twice does not change the current view
    twice = O.ledger_current(O.ledger_rows(ranges.unionByName(ranges)))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, current.collect()))


def test_resume_plan_topics(spark):
    current = O.ledger_current(
        O.ledger_rows(
            spark.createDataFrame(
                [(0, "a", 0, 0, 4), (0, "b", 0, 0, 2)],
                "batch_id long, topic string, partition int, from_offset long, until_offset long",
            )
        )
    )
    assert {r.topic for r in O.resume_plan(current, ["a", "new"]).collect()} == {"a"}
    assert {r.topic for r in O.resume_plan(current, ["a"], strict_ledger=True).collect()} == {"a", "b"}
    js = TL.starting_offsets_json(O.resume_plan(current, ["a", "b"], which="until"))
    assert js == '{"a": {"0": 4}, "b": {"0": 2}}'


def test_fill_absent_partitions(spark):
    prev = O.ledger_current(
        O.ledger_rows(
            spark.createDataFrame(
                [(3, "a", 0, 0, 4), (3, "a", 1, 7, 9)],
                "batch_id long, topic string, partition int, from_offset long, until_offset long",
            )
        )
    )
    batch = spark.createDataFrame([("a", 0, 4), ("a", 0, 5), ("a", 2, 0)], "topic string, partition int, offset long")
    got = {tuple(r) for r in O.fill_absent_partitions(O.batch_ranges(batch), prev, 4).collect()}
    assert got == {(4, "a", 0, 4, 6), (4, "a", 1, 9, 9), (4, "a", 2, 0, 1)}


def test_documents_log_matches_window_rank(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    k = TL.fixture_ends(docs).count()
    log = TL.documents_topic_log(docs, keys_bound=k)
    got = log.select("topic", "partition", "offset", "batch_id", F.decode("key", "UTF-8").alias("k")).toPandas()
    pdf = docs.select("doc_id", "lang").toPandas()
    pdf["partition"] = pdf.doc_id % 3
    pdf["offset"] = pdf.groupby(["lang", "partition"]).doc_id.rank(method="first").astype("int64") - 1
    want = {(r.lang, r.partition, r.offset, r.offset // 10, str(r.doc_id)) for r in pdf.itertuples()}
    assert {tuple(r) for r in got.itertuples(index=False)} == want
    assert k == len(pdf.groupby(["lang", "partition"]))


def test_fixture_tail_is_the_end_of_the_log(spark):
    """Nothing but each partition's last batch is ranked, and it equals the log's end."""
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    ends = TL.fixture_ends(docs)
    starts = ends.selectExpr("topic", "partition", "greatest(0, end_offset - 1 - pmod(hash(topic, partition), 7)) AS start_offset")
    tail = TL.fixture_tail(docs, starts, ends, 10, keys_bound=12)
    log = TL.documents_topic_log(docs).join(starts, ["topic", "partition"]).where("offset >= start_offset")
    want = {(r.topic, r.partition, int(r.key), r.offset) for r in log.collect()}
    assert {tuple(r) for r in tail.collect()} == want
    plan = tail._jdf.queryExecution().executedPlan().toString()
    # each scan task keeps its last messages before the shuffle
    assert re.search(r"WindowGroupLimit.*Partial", plan) and "RangePartitioning" not in plan


def test_subscribe_and_topics_parse(spark):
    assert TL.parse_topics("test,test2,test, ,") == ["test", "test2"]
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    log = TL.documents_topic_log(docs, topics="en,de")
    assert {r.topic for r in log.select("topic").distinct().collect()} <= {"en", "de"}
    plan = log._jdf.queryExecution().executedPlan().toString()
    # the subscription reaches the Parquet scan
    assert re.search(r"PushedFilters: \[[^\n]*In\(lang, \[de,en\]\)", plan)


def test_dense_ranges_random(spark):
    import random

    rnd = random.Random(5)
    for trial in range(3):
        ends = {(f"t{rnd.randint(0, 2)}", p): rnd.randint(1, 60) for p in range(rnd.randint(1, 6))}
        n = rnd.randint(1, 12)
        last = max((e - 1) // n for e in ends.values())
        want = {
            (b, t, p, min(b * n, e), min((b + 1) * n, e))
            for (t, p), e in ends.items()
            for b in range(last + 1)
        }
        got = O.dense_ranges(_log(spark, ends), n).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want, (ends, n)


def test_resume_on_persisted_log_does_not_shuffle_messages(spark, scratch):
    """On a log that carries its offsets, resuming is a scan streamed into a
    broadcast join: no exchange between the message scan and the join."""
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    TL.write_topic_log(TL.documents_topic_log(docs).drop("batch_id"), f"{scratch}/log", "overwrite")
    log = TL.read_topic_log(spark, f"{scratch}/log", "en,de")
    current = O.ledger_current(O.ledger_rows(O.dense_ranges(TL.with_batch_ids(log, 10), 10)))
    q = TL.message_values(O.resume_messages(log, O.resume_offsets(current), partitions_bound=12))
    q.collect()
    plan = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.split("\n")
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "value#" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join:scan])
