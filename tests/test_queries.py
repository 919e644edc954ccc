"""Every registered query against its DuckDB oracle on the smoke tables."""

import duckdb
import pytest

import __spark_entry__ as E
from quillstream.plans.oracles import ORACLES
from quillstream.plans.registry import QUERIES
from conftest import SMOKE_DIR

TABLES = ["documents", "events", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).decode()
    return v


def _rows(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(t[i]) for i in order) for t in tuples), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMOKE_DIR)
    got = df.collect()
    rel = con.sql(E.oracle_sql()[name])
    exp = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(exp)
    assert _rows(df.columns, [tuple(r) for r in got]) == _rows(rel.columns, exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "total"]
    assert df.count() > 0


def test_cell_upsert_depends_on_the_order_of_the_puts(spark):
    """The table after the puts is neither the scan of the events nor what puts
    without their sequence would leave."""
    from quillstream.operators import cells as C

    scan = QUERIES["cell_scan"](spark, SMOKE_DIR)
    after = QUERIES["cell_upsert"](spark, SMOKE_DIR)
    assert after.exceptAll(scan).count() > 0 and scan.exceptAll(after).count() > 0
    # some puts must lose, some must win
    marked = after.where("value like '%!'").count()
    assert 0 < marked < after.count()
    upsert = C.upsert
    try:
        C.upsert = lambda base, puts: upsert(base, puts.withColumn("seq", -puts.seq))
        assert QUERIES["cell_upsert"](spark, SMOKE_DIR).exceptAll(after).count() > 0
    finally:
        C.upsert = upsert


def test_offset_queries_have_no_window_and_no_product(spark):
    for name in ("offset_ledger", "resume_offsets"):
        plan = QUERIES[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Generate" not in plan and "Join" not in plan, name


def test_cell_rows_scans_once_and_takes_any_number_of_qualifiers(spark):
    from quillstream.operators import cells as C

    query = QUERIES["cell_rows"](spark, SMOKE_DIR)
    assert query._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    wide = spark.range(2200).selectExpr(
        "cast(id % 2 as string) row_key", "'w1' family", "concat('q', id) qualifier",
        "timestamp_ntz'2024-01-01 00:00:00' ts", "id seq", "if(id = 5, null, cast(id as string)) value",
    )
    rows = {r.row_key: r.cells.split(";") for r in C.row_strings(wide).collect()}
    assert rows["0"] == [f"w1:{q}={q[1:]}" for q in sorted(f"q{i}" for i in range(0, 2200, 2))]
    assert len(rows["1"]) == 1100 and "w1:q5=" in rows["1"]
