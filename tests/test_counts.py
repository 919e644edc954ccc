"""Word counts: DataFrame, 32-bit, SQL, per batch, top rows."""


from quillstream.operators import counts

LINES = ["the cat the", "a  b", "", "the ", " x"]


def _df(spark):
    return spark.createDataFrame([(i % 2, s) for i, s in enumerate(LINES)], "batch_id long, value string")


def _py_counts(lines):
    out = {}
    for s in lines:
        toks = [""] if s == "" else s.rstrip(" ").split(" ") if s.rstrip(" ") else []
        for t in toks:
            out[t] = out.get(t, 0) + 1
    return out


def test_forms_agree(spark):
    words = counts.tokenize(_df(spark))
    a = {r.word: r.total for r in counts.word_count(words).collect()}
    b = {r.word: r.total for r in counts.word_count_sql(words).collect()}
    c = {r.word: r.total for r in counts.word_count_int(words).collect()}
    assert a == b == c == _py_counts(LINES)
    assert dict(counts.word_count_int(words).dtypes)["total"] == "int"
    assert dict(counts.word_count(words).dtypes)["total"] == "bigint"


def test_per_batch_is_not_cumulative(spark):
    words = counts.tokenize(_df(spark), keep=["batch_id"])
    got = {(r.batch_id, r.word): r.total for r in counts.batch_word_count(words).collect()}
    want = {}
    for i, s in enumerate(LINES):
        for w, n in _py_counts([s]).items():
            want[(i % 2, w)] = want.get((i % 2, w), 0) + n
    assert got == want


def test_top_words_order(spark):
    words = counts.tokenize(_df(spark))
    top = [(r.word, r.total) for r in counts.top_words(counts.word_count(words), 3).collect()]
    assert top == [("", 3), ("the", 3), ("a", 1)]
    plan = counts.top_words(counts.word_count(words), 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_count_plan_is_partial_hash_aggregate(spark):
    words = counts.tokenize(_df(spark))
    plan = counts.word_count(words)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "HashAggregate" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_lines_then_words(spark):
    df = spark.createDataFrame([("a b\n\nc \r\nd",)], "value string")
    got = sorted(r.word for r in counts.tokenize_lines(df).collect())
    assert got == ["", "a", "b", "c", "d"]


def test_spread_only_for_narrow_scans(spark):
    from quillstream.sources.tables import spread

    narrow = spark.range(100).coalesce(1)
    wide = spark.range(0, 100, 1, 16)
    assert spread(narrow, ["id"], min_partitions=8).rdd.getNumPartitions() == 8
    same = spread(wide, ["id"], min_partitions=8)
    assert same is wide  # already wide: untouched, no exchange added
