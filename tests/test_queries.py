"""Every query with an oracle agrees with it; the entry module keeps its contract."""

import harness
import pytest

from unitflow import queries


@pytest.fixture(scope="module")
def con(small):
    return harness.connect(small)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agrees_with_its_oracle(spark, con, small, name):
    names, got, want = harness.compare(spark, con, queries.QUERIES[name], queries.ORACLES[name], small)
    assert names
    assert got == want


def test_pace_at_a_threshold(spark, tmp_path):
    """Sums that meet a threshold exactly: in any order of the rows the SQL's doubles sum to it too, but sums of days do not."""
    import datetime

    import duckdb

    day, ids = datetime.datetime(2024, 1, 17, 12), (i for i in range(10**6) if all(i % m for m in (13, 17, 19)) and i % 25 > 2)
    users = {3: (0.43, 0.93, 2.06, 3.58), 2: (1.48, 2.66, 1.84, 0.02), 1: (0.02, 0.67, 2.09, 2.22), 4: (7.2,), 5: (3.0,)}
    rows = [(next(ids), day + datetime.timedelta(days=k // 2), u, "click", v, "{}") for u, vs in users.items() for k, v in enumerate(vs)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    names, got, want = harness.compare(spark, con, queries.pace_status_ladder, queries.ORACLES["pace_status_ladder"], str(tmp_path))
    assert names
    assert got == want == [(1, "behind"), (10, "at risk"), (4, "on track")]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())


def test_fingerprint_ignores_order_and_sees_changes(spark, small):
    from pyspark.sql import functions as F

    from unitflow.operators.changes import fingerprint
    from unitflow.sources.adaptors import table

    o = table(spark, small, "orders")
    a = fingerprint(o).first()
    assert a == fingerprint(o.orderBy(F.rand(1))).first()
    assert a != fingerprint(o.withColumn("o_custkey", F.col("o_custkey") + (F.col("o_orderkey") == 1).cast("int"))).first()
