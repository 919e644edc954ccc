"""Broadcast only under a known row bound."""

from quillstream.operators.joins import MAX_BROADCAST_ROWS, join_bounded


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_under_bound(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no automatic broadcasts
    try:
        big = spark.range(1000).selectExpr("id % 10 AS k", "id")
        small = spark.range(10).selectExpr("id AS k", "id * 2 AS v")
        assert "BroadcastHashJoin" in _plan(join_bounded(big, small, ["k"], small_rows=10))
        assert "BroadcastHashJoin" not in _plan(join_bounded(big, small, ["k"], small_rows=None))
        over = join_bounded(big, small, ["k"], small_rows=MAX_BROADCAST_ROWS + 1)
        assert "BroadcastHashJoin" not in _plan(over)
        assert over.count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
