"""Distributed numbering vs. a brute-force rank, including a hot key."""

import random

import pandas as pd
import pytest

from quillstream.operators import numbering
from quillstream.operators.numbering import number_within


def _brute(rows):
    pdf = pd.DataFrame(rows, columns=["k", "o"])
    pdf["n"] = pdf.groupby("k")["o"].rank(method="first").astype("int64") - 1
    return {(r.k, r.o): r.n for r in pdf.itertuples()}


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_number_within_matches_rank(spark, ranges):
    rnd = random.Random(ranges)
    rows = []
    # one key holds a third of the rows; sparse and negative order values
    for i in range(600):
        rows.append(("hot", i * 7 - 900))
    for k in range(40):
        for o in rnd.sample(range(-5000, 5000), rnd.randint(1, 30)):
            rows.append((f"k{k}", o))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long").repartition(5)
    for bound in (None, 41):
        got = number_within(df, ["k"], "o", "n", keys_bound=bound, ranges=ranges).collect()
        assert len(got) == len(rows)
        assert {(r.k, r.o): r.n for r in got} == _brute(rows)


@pytest.mark.parametrize("ids", ["dense", "sparse", "crowded"])
def test_ranges_stay_even_whatever_the_ids(spark, ids, monkeypatch):
    """One key holds half of the rows; ids are dense, hashed over 62 bits, or
    crowded in a small part of their range. No range gets much more than its share,
    and the segment table has at most a row a key and range."""
    order = {"dense": "id", "sparse": "xxhash64(id) & 4611686018427387903", "crowded": "if(id % 10 = 0, xxhash64(id), id)"}[ids]
    n = 100_000
    df = spark.range(n).selectExpr("if(id % 2 = 0, 'hot', concat('k', id % 97)) AS k", f"{order} AS o").dropDuplicates(["k", "o"]).cache()
    seen = {}
    kept = numbering.segments

    def spy(placed, keys):
        seen["ranges"] = placed.groupBy("_qs_group._qs_at").count().collect()
        out = kept(placed, keys)
        seen["segments"] = out.count()
        return out

    monkeypatch.setattr(numbering, "segments", spy)
    got = number_within(df, ["k"], "o", "n", ranges=16)
    assert {(r.k, r.o): r.n for r in got.collect()} == _brute([tuple(r) for r in df.collect()])
    assert len(seen["ranges"]) >= 12 and max(r["count"] for r in seen["ranges"]) <= 3 * n / 16
    assert seen["segments"] <= 98 + 15
    df.unpersist()


def test_plan_has_no_window_over_the_rows_and_no_sketch(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([("a", 5)], "k string, o long")
        plan = number_within(df, ["k"], "o", "n", keys_bound=1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "row_number" not in plan and "percentile" not in plan
    # the only window adds up rows of segments, after their partial aggregation
    assert plan.count("Window [") == 1 and "sum(_qs_rows" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_order_by_several_columns(spark):
    rows = [(i % 3, (i * 7) % 5, f"{(i * 11) % 100:02}") for i in range(100)]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    got = number_within(df, ["k"], ["a", "b"], "n", ranges=7).collect()
    for k in range(3):
        mine = sorted((r.n, r.a, r.b) for r in got if r.k == k)
        assert [n for n, _, _ in mine] == list(range(len(mine)))
        assert [x[1:] for x in mine] == sorted(x[1:] for x in mine)


def test_numbering_is_deterministic_across_layouts(spark):
    """Same offsets whatever the partitioning (what a recomputed stage after a
    lost executor relies on): shuffle partition counts, AQE on/off, input
    partitioning."""
    rows = [("hot" if i % 3 else f"k{i % 7}", (i * 7919) % 5003) for i in range(3000)]
    base = spark.createDataFrame(rows, "k string, o long").dropDuplicates(["k", "o"])
    results = []
    for parts, aqe, inputs in [(8, "true", 1), (3, "false", 5), (17, "true", 7)]:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        got = number_within(base.repartition(inputs), ["k"], "o", "n").select("k", "o", "n")
        results.append(sorted(map(tuple, got.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert results[0] == results[1] == results[2]


def test_null_keys_and_orders_are_kept(spark):
    rows = [("a", 3), ("a", None), ("a", 1), (None, 5), (None, 2), (None, None), ("b", None)]
    df = spark.createDataFrame(rows, "k string, o long")
    for bound in (None, 3):
        got = sorted(map(tuple, number_within(df, ["k"], "o", "n", keys_bound=bound).select("k", "o", "n").collect()), key=repr)
        want = sorted([("a", None, 0), ("a", 1, 1), ("a", 3, 2), (None, None, 0), (None, 2, 1), (None, 5, 2),
                       ("b", None, 0)], key=repr)
        assert got == want


def test_duplicate_orders_still_dense(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("a", 2)] * 3, "k string, o long")
    got = sorted(r.n for r in number_within(df, ["k"], "o", "n").collect())
    assert got == list(range(8))


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([("a", 1, "x")], "k string, o long, n string")
    assert number_within(df.limit(0), ["k"], "o", "m").count() == 0
    got = number_within(df, ["k"], "o", "m").collect()
    assert [tuple(r) for r in got] == [("a", 1, "x", 0)]
    assert got[0].__fields__ == ["k", "o", "n", "m"]


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from quillstream import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
