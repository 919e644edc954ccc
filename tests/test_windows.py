"""Sliding counts: brute force, and the stream form against the batch form."""

from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quillstream.operators.windows import closed_windows, sliding_count
from quillstream.streaming.windows import start_sliding_count_stream

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, word string"


def at(minutes, word="a"):
    return (START + timedelta(minutes=minutes), word)


def brute(rows):
    out = Counter()
    for ts, word in rows:
        if ts is not None:
            first = ts - timedelta(minutes=ts.minute % 5, seconds=ts.second, microseconds=ts.microsecond)
            for start in (first, first - timedelta(minutes=5)):
                out[start, word] += 1
    return out


def counted(df):
    return Counter({(r.window_start, r.word): r.n for r in df.collect()})


def test_sliding_count_matches_brute_force(spark):
    rows = [at(i * 0.37, f"w{i % 4}") for i in range(400)] + [at(5), at(5, None), at(10 - 1e-6), (None, "a")]
    got = sliding_count(spark.createDataFrame(rows, SCHEMA), "ts", "word")
    assert got.columns == ["window_start", "window_end", "word", "n"]
    assert counted(got) == brute(rows)
    assert sliding_count(spark.createDataFrame([], SCHEMA), "ts", "word").count() == 0


def test_other_sizes(spark):
    rows = [at(i, "w") for i in range(100)]
    got = counted(sliding_count(spark.createDataFrame(rows, SCHEMA), "ts", "word", "30 minutes", "10 minutes"))
    assert got[START, "w"] == 30 and got[START + timedelta(minutes=90), "w"] == 10 and sum(got.values()) == 300


def run(spark, src, base, delay="10 minutes"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(src)
    query = start_sliding_count_stream(stream, f"{base}/out", "sliding", "ts", "word", delay=delay, trigger={"availableNow": True}, checkpoint=f"{base}/ck")
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def put(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)


def test_stream_with_late_rows_and_a_restart_equals_the_batch(spark, scratch):
    src = f"{scratch}/src"
    first = [at(i * 0.5, f"w{i % 3}") for i in range(120)]     # to minute 59.5
    put(spark, src, first)
    run(spark, src, scratch)
    # watermark 49.5: a row at minute 45 is not late for its window that ends at 50, one at minute 20 is
    in_time, late = [at(45.5, "w0")], [at(20, "w0"), at(12, "late")]
    put(spark, src, in_time + late)
    run(spark, src, scratch)                                   # restarted: state and watermark come back
    last = [at(60 + i, f"w{i % 2}") for i in range(50)]        # to minute 109
    put(spark, src, last)
    run(spark, src, scratch)

    out = spark.read.parquet(f"{scratch}/out")
    assert out.groupBy("window_start", "word").count().where("count > 1").count() == 0  # once each
    batch = sliding_count(spark.createDataFrame(first + in_time + last, SCHEMA), "ts", "word")
    closed = closed_windows(batch, F.lit(START + timedelta(minutes=99)))
    assert closed.count() > 40
    assert counted(out) == counted(closed)
    assert (START + timedelta(minutes=40), "w0") in counted(out)


def test_all_windows_of_the_stream_equal_the_batch_of_the_events(spark, scratch):
    """Open windows too: the last update of every window, over the whole events table."""
    from conftest import SMOKE_DIR

    events = spark.read.parquet(f"{SMOKE_DIR}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("word"))
    events.repartitionByRange(3, "ts").write.parquet(f"{scratch}/src")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/src")
    # files come in any order, so the watermark allows for the whole span
    counts = sliding_count(stream, "ts", "word", delay="60 days")
    query = counts.writeStream.outputMode("update").format("memory").queryName("sliding_all").trigger(availableNow=True).start()
    query.awaitTermination(120)
    updates = spark.table("sliding_all").groupBy("window_start", "word").agg(F.max("n").alias("n"))
    assert counted(updates) == counted(sliding_count(events, "ts", "word"))


def test_plan_combines_before_the_shuffle(spark):
    plan = sliding_count(spark.createDataFrame([at(1)], SCHEMA), "ts", "word")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 1 and plan.count("Exchange hashpartitioning") == 1
