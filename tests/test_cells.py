"""Versioned cell table: newest-version scans, rows, upserts, golden cells."""

from pyspark.sql import functions as F

from quillstream.operators import cells as C
from quillstream.operators.reduce import last_by

SCHEMA = "row_key string, family string, qualifier string, ts timestamp_ntz, seq long, value string"


def _cells(spark, rows):
    return spark.createDataFrame(rows, SCHEMA) if rows else spark.createDataFrame([], SCHEMA)


def test_golden_puts(spark):
    """The two literal puts of the reference, applied as one put batch."""
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    base = _cells(spark, [])
    puts = _cells(spark, [("rowkey2", "w1", "b", t, 1, "value2"), ("rowkey11", "w1", "Z", t, 2, "value3")])
    got = {(r.row_key, r.family, r.qualifier, r.value) for r in C.upsert(base, puts).collect()}
    assert got == {("rowkey2", "w1", "b", "value2"), ("rowkey11", "w1", "Z", "value3")}
    kv = {r.key: r.value for r in C.key_values(C.newest_cells(puts)).collect()}
    assert kv == {
        "rowkey2/w1:b/2024-01-01 00:00:00.000000": "value2",
        "rowkey11/w1:Z/2024-01-01 00:00:00.000000": "value3",
    }


def test_newest_version_wins_ties_by_seq(spark):
    import datetime as dt

    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    cells = _cells(
        spark,
        [
            ("r", "f", "q", t1, 9, "old"),
            ("r", "f", "q", t2, 1, "a"),
            ("r", "f", "q", t2, 2, "b"),
            ("r", "f", "p", t1, 1, "p1"),
        ],
    )
    got = {r.qualifier: (r.ts, r.value) for r in C.newest_cells(cells).collect()}
    assert got == {"q": (t2, "b"), "p": (t1, "p1")}
    # an older put does not replace a newer cell
    older = _cells(spark, [("r", "f", "q", t1, 99, "late-but-old")])
    assert {r.value for r in C.upsert(cells, older).where("qualifier = 'q'").collect()} == {"b"}


def test_whole_rows_and_maps(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    cells = _cells(
        spark,
        [("r1", "w1", "a", t, 1, "x"), ("r1", "w1", "a", t, 2, "y"), ("r1", "w1", "b", t, 1, "z"), ("r2", "w1", "b", t, 1, "w")],
    )
    rows = {r.row_key: (r.a, r.b) for r in C.whole_rows(cells, ["a", "b"]).collect()}
    assert rows == {"r1": ("y", "z"), "r2": (None, "w")}
    maps = {r.row_key: r.cells for r in C.row_maps(cells).collect()}
    assert maps == {"r1": {"w1:a": "y", "w1:b": "z"}, "r2": {"w1:b": "w"}}
    assert [r.value for r in C.lookup(cells, "r2").collect()] == ["w"]


def test_counts_as_cells(spark):
    counts = spark.createDataFrame([("hello", 3), ("", 1)], "word string, total long")
    got = {tuple(r) for r in C.counts_as_cells(counts).collect()}
    assert got == {("hello", "w1", "total", "3"), ("", "w1", "total", "1")}


def test_hot_row_key_aggregates_partially(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("row_key"),
        F.lit("w1").alias("family"),
        F.lit("q").alias("qualifier"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("seq"),
        F.col("id").cast("string").alias("value"),
    )
    q = C.newest_cells(df)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert q.where("row_key = 'hot'").first().value == "2997"


def test_last_by_explicit_order(spark):
    df = spark.createDataFrame([(1, 10, 1, 5.0), (1, 10, 2, 6.0), (1, 9, 3, 7.0), (2, 1, 1, 1.0)], "k int, ts int, id int, v double")
    got = {r.k: r.v for r in last_by(df, ["k"], "v", ["ts", "id"]).collect()}
    assert got == {1: 6.0, 2: 1.0}


def test_table_available(spark, scratch):
    from quillstream.sources.tables import table_available

    assert not table_available(spark, f"{scratch}/none")
    assert not table_available(spark, "qs_no_such_table")
    spark.range(3).write.parquet(f"{scratch}/t")
    assert table_available(spark, f"{scratch}/t")


def test_compact_cells(spark, scratch):
    import datetime as dt

    from quillstream.sinks.tables import compact_cells, write_batch

    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    cells = _cells(spark, [("r", "f", "q", t1, 1, "a"), ("r", "f", "q", t2, 2, "b"), ("s", "f", "q", t1, 3, "c")])
    write_batch(cells, f"{scratch}/cells", 0, "r1")
    compact_cells(spark, f"{scratch}/cells", f"{scratch}/compact")
    got = {(r.row_key, r.value, r.seq) for r in spark.read.parquet(f"{scratch}/compact").collect()}
    assert got == {("r", "b", 2), ("s", "c", 3)}


def test_whole_rows_family_qualified_names(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    cells = _cells(spark, [("r", "w1", "q", t, 1, "one"), ("r", "w2", "q", t, 2, "two")])
    got = C.whole_rows(cells, ["w1:q", "w2:q", "q"]).first()
    assert (got["w1:q"], got["w2:q"], got["q"]) == ("one", "two", "two")
    assert C.whole_rows(cells, ["q"], family="w1").first()["q"] == "one"


def test_stored_table_sample_sequence(spark, scratch):
    """Availability check, scan, put one cell, scan again, key/value listing,
    whole rows: the cell-table sample sequence, on a stored table."""
    from quillstream.sinks.tables import append_cells, read_cells
    from quillstream.sources.tables import table_available

    path = f"{scratch}/WordCount"
    assert not table_available(spark, path)
    assert read_cells(spark, path).count() == 0
    put = spark.createDataFrame([("rowkey2", "w1", "b", "value2")], "row_key string, family string, qualifier string, value string")
    append_cells(put, path, seq=1)
    assert table_available(spark, path)
    cells = read_cells(spark, path)
    assert [(r.row_key, r.family, r.qualifier, r.value) for r in C.newest_cells(cells).collect()] == [
        ("rowkey2", "w1", "b", "value2")
    ]
    assert [r.value for r in C.key_values(C.newest_cells(cells)).collect()] == ["value2"]
    # a second put of the same cell is a newer version
    append_cells(put.selectExpr("row_key", "family", "qualifier", "'value3' AS value"), path, seq=2)
    rows = C.whole_rows(read_cells(spark, path), ["b"], family="w1").collect()
    assert [(r.row_key, r.b) for r in rows] == [("rowkey2", "value3")]


def test_puts_after_compaction_still_win(spark, scratch):
    from quillstream.sinks.tables import append_cells, compact_cells, read_cells

    put = spark.createDataFrame([("r", "w1", "q", "old")], "row_key string, family string, qualifier string, value string")
    append_cells(put, f"{scratch}/cells", seq=1)
    append_cells(put.selectExpr("row_key", "family", "qualifier", "'mid' AS value"), f"{scratch}/cells", seq=2)
    compact_cells(spark, f"{scratch}/cells", f"{scratch}/compact")
    assert read_cells(spark, f"{scratch}/compact").count() == 1
    append_cells(put.selectExpr("row_key", "family", "qualifier", "'new' AS value"), f"{scratch}/compact", seq=3)
    assert [r.value for r in C.newest_cells(read_cells(spark, f"{scratch}/compact")).collect()] == ["new"]


PUT = "row_key string, family string, qualifier string, value string"


def _stream_batch(spark, path, batch_id, text, run="r1"):
    from quillstream.streaming.batches import BatchOutputs, process_batch

    process_batch(spark.createDataFrame([(text,)], "value string"), batch_id, BatchOutputs(cells=path, run=run))


def _newest(spark, path):
    from quillstream.sinks.tables import read_cells

    return {r.row_key: r.value for r in C.newest_cells(read_cells(spark, path)).collect()}


def test_stream_and_puts_share_one_table(spark, scratch):
    """Whatever the order of stream batches, puts and compaction, no cell is lost."""
    from quillstream.sinks.tables import append_cells, compact_cells

    put = spark.createDataFrame([("rowkey2", "w1", "b", "value2")], PUT)
    a, b = f"{scratch}/a", f"{scratch}/b"
    _stream_batch(spark, a, 0, "x y y")
    append_cells(put, a)                       # stream, then put
    append_cells(put, b)
    _stream_batch(spark, b, 0, "x y y")        # put, then stream
    want = {"x": "1", "y": "2", "rowkey2": "value2"}
    assert _newest(spark, a) == want and _newest(spark, b) == want
    compact_cells(spark, a, f"{scratch}/c")
    assert _newest(spark, f"{scratch}/c") == want
    _stream_batch(spark, f"{scratch}/c", 1, "y z")   # compact, then stream and put
    append_cells(put.selectExpr("row_key", "family", "qualifier", "'value3' AS value"), f"{scratch}/c")
    assert _newest(spark, f"{scratch}/c") == {"x": "1", "y": "1", "z": "1", "rowkey2": "value3"}


def test_files_outside_the_layout_are_refused(spark, scratch):
    import pytest

    from quillstream.sinks.tables import read_cells

    _stream_batch(spark, f"{scratch}/t", 0, "x")
    _cells(spark, [("r", "f", "q", None, 1, "v")]).write.mode("append").parquet(f"{scratch}/t")
    with pytest.raises(ValueError, match="outside"):
        read_cells(spark, f"{scratch}/t")
