"""Stores, loads, sources, orchestration, publishing and streams."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from unitflow.operators import changes
from unitflow.plans import orchestration as orc
from unitflow.plans import files, metrics, pipeline, publish, store
from unitflow.queries import util
from unitflow.sources import adaptors, api, lake
from unitflow.streaming import sessions as stream


def test_snapshots_move_the_pointer_only_when_accepted(spark, tmp_path):
    s = store.Store(tmp_path)
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert s.build("r1", {"t": df})
    assert not s.build("r2", {"t": df.withColumn("v", F.lit("b"))}, lambda t: t["t"].where("v = 'a'").count() == 1)
    assert s.pointer() == "r1"
    assert s.read(spark, "t").first().v == "a"
    assert s.tables("r2", "rejected") == {"t": "data/r2/t"}
    assert s.tables("r2") == {}
    assert s.build("r3", {"t": df.withColumn("v", F.lit("c"))})
    s.rollback()
    assert s.pointer() == "r1"
    with s.lock(), pytest.raises(store.Busy):
        s.build("r4", {"t": df})
    assert s.build("r5", {"t": df})


def test_incremental_equals_full(spark, tmp_path):
    s = store.Store(tmp_path)
    rows = [(i, date(2026, 1, 1 + i), float(i)) for i in range(20)]
    schema = "id int, d date, v double"
    day1 = spark.createDataFrame(rows[:12], schema)
    # the second extract corrects two days within the lookback
    day2 = spark.createDataFrame([(i, d, v + 100 if 8 <= i < 12 else v) for i, d, v in rows], schema)
    a = store.load_incrementally(s, spark, "ehr", "t", day1, "d", ["id"], 4, "r1")
    b = store.load_incrementally(s, spark, "ehr", "t", day2, "d", ["id"], 4, "r2")
    assert (a["read_from"], a["mark"]) == (None, "2026-01-12")
    assert (b["read_from"], b["mark"], b["rows"]) == ("2026-01-08", "2026-01-20", 13)
    assert changes.fingerprint(s.read(spark, "t")).first() == changes.fingerprint(day2).first()
    again = store.load_incrementally(s, spark, "ehr", "t", day2, "d", ["id"], 4, "r3")
    assert again["mark"] == "2026-01-20"
    assert changes.fingerprint(s.read(spark, "t")).first() == changes.fingerprint(day2).first()


def test_incremental_loads_leave_other_tables(spark, tmp_path):
    s = store.Store(tmp_path)
    a = spark.createDataFrame([(1, date(2026, 1, 1), 1.0)], "id int, d date, v double")
    b = spark.createDataFrame([(7, date(2026, 1, 2), 7.0)], "id int, d date, v double")
    assert s.build("r0", {"a": a, "b": b})
    store.load_incrementally(s, spark, "ehr", "a", a.withColumn("v", F.lit(5.0)), "d", ["id"], 3, "r1")
    store.load_incrementally(s, spark, "ehr", "b", b.unionByName(a), "d", ["id"], 3, "r2")
    assert s.read(spark, "a").first().v == 5.0
    assert sorted(r.id for r in s.read(spark, "b").collect()) == [1, 7]
    s.rollback()
    assert [r.id for r in s.read(spark, "b").collect()] == [7]
    with pytest.raises(KeyError, match="no table c"):
        s.read(spark, "c")


def test_bad_exports_never_replace_good_ones(spark, tmp_path):
    f = files.Files(spark, str(tmp_path))
    f.make("exports.new")
    f.write("exports.new/x", "one")
    assert pipeline.swap_exports(f, lambda: []) == []
    f.make("exports.new")
    f.write("exports.new/x", "two")
    assert pipeline.swap_exports(f, lambda: ["wrong"]) == ["wrong"]
    assert f.read("exports/x") == "one"
    assert not f.exists("exports.new")
    f.make("exports.new")
    f.write("exports.new/x", "three")
    pipeline.swap_exports(f, lambda: [])
    assert f.read("exports/x") == "three"
    assert f.names() == ["exports"]


def test_report_contract():
    text = "Units =\n  SUM ( fact[units_delivered] ) // not fact[minutes]\n\nHours =\n  [Units] / 4\n"
    assert set(metrics.measures(text)) == {"Units", "Hours"}
    wanted = {"Units": ("units_delivered", "minutes"), "Hours": ("units_delivered",), "Gone": ("x",)}
    assert metrics.contract(text, wanted) == {"Units": ["minutes"], "Hours": [], "Gone": None}


def test_landing_and_declared_schemas(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "reference_centers.csv").write_text("center_id,center_name,state\nC1,One,\n")
    b = lake.choose_backend(spark, None, tmp_path / "lake")
    one = lake.land(raw, "2026-01-01", b)
    df = lake.read_lake(spark, b, "2026-01-01")["reference_centers.csv"]
    assert [tuple(r) for r in df.collect()] == [("C1", "One", None)]
    (raw / "reference_centers.csv").write_text("center_id,center_name,state\nC2,Two,WA\n")
    two = lake.land(raw, "2026-01-02", b)
    assert lake.changed_since(one, two) == {"new": [], "changed": ["reference_centers.csv"], "same": []}
    assert lake.manifest(b, "2026-01-01") == one
    assert lake.manifest(b, "1999-01-01") is None
    assert lake.digests(spark, b.uri(one[0].key)).first().sha256 == one[0].sha256
    with pytest.raises(lake.CredentialError):
        lake.choose_backend(spark, "s3a://x", tmp_path, {"AWS_ACCESS_KEY_ID": "a"})
    with pytest.raises(KeyError):
        lake.source_of("odd.csv")


def test_pages_retries_and_completeness(spark, tmp_path):
    rows = [{"auth_id": f"A{i}", "units": float(i)} for i in range(250)]
    waits = []
    got = api.fetch_all(api.fake_api(rows, 100, {2: api.APIError(429, retry_after=3.0), 4: api.APIError(503)}), sleep=waits.append)
    assert got.rows == rows
    assert got.retries == 2
    assert waits[0] == 3.0
    with pytest.raises(api.APIError):
        api.fetch_all(api.fake_api(rows, 100, {1: api.APIError(404)}), sleep=waits.append)
    with pytest.raises(api.IncompleteError):
        api.fetch_all(lambda c: api.Page([{}], "same", None), sleep=waits.append)
    with pytest.raises(api.IncompleteError):
        api.fetch_all(lambda c: api.Page([{}], None, 5), sleep=waits.append)
    path = tmp_path / "a.csv"
    path.write_text("auth_id,units\nA1,2\nA2,\n")
    assert api.fetch_all(api.csv_api(str(path), 1), sleep=waits.append).rows == [{"auth_id": "A1", "units": "2"}, {"auth_id": "A2", "units": None}]
    api.register(spark, "payer_api", "auth_id string, units double", api.fake_api(rows))
    assert spark.read.format("payer_api").load().agg(F.sum("units")).first()[0] == sum(range(250))


def test_orchestration():
    waits, calls = [], []

    def flaky(ctx):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("later")
        return {"x": 1}

    def boom(ctx):
        raise ValueError("no")

    tasks = [orc.Task("c", lambda c: {"y": c["x"] + 1}, ("a",)), orc.Task("a", flaky, (), 2, 0.5), orc.Task("b", boom), orc.Task("d", lambda c: {}, ("b", "a"))]
    r = orc.Orchestrator(tasks, sleep=waits.append).run()
    assert [(x.name, x.status, x.attempts) for x in r.runs] == [("a", "ok", 3), ("c", "ok", 1), ("b", "failed", 1), ("d", "skipped", 0)]
    assert waits == [0.5, 1.0]
    assert r.context["y"] == 2
    assert r.failed_task == "b"
    with pytest.raises(ValueError, match="cycle"):
        orc.toposort([orc.Task("a", boom, ("b",)), orc.Task("b", boom, ("a",))])
    with pytest.raises(ValueError, match="no task"):
        orc.toposort([orc.Task("a", boom, ("z",))])


def test_published_headline_is_checked(spark, small, tmp_path):
    u = util(spark, small)
    p = publish.payload(u, b"k")
    path = tmp_path / "p.json"
    publish.write_payload(p, path)
    assert publish.verify_payload(path, u) == []
    p["headline"]["open_auths"] += 1
    publish.write_payload(p, path)
    assert len(publish.verify_payload(path, u)) == 1
    path.write_text("{}")
    assert publish.verify_payload(path, u)
    assert all(r["client_id"].startswith("CLI-") and len(r["client_id"]) == 16 for r in p["at_risk"])
    text = publish.digest(u, b"k")
    assert "Weekly digest" in text
    assert "more |" in text
    assert "</" not in publish.dashboard(p).split("application/json")[1].split("</script>")[0]
    publish.export_csv(u.select("auth_id", "is_closed", "period_end", "pace"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == u.count()
    assert publish.json_safe({"a": [float("nan"), 1.0]}) == {"a": [None, 1.0]}
    assert json.dumps(publish.json_safe({"d": date(2026, 1, 1)})) == '{"d": "2026-01-01"}'


def test_stream_counts_equal_batch_counts(spark, small, tmp_path):
    e = adaptors.table(spark, small, "events").select("event_id", "ts", "event_type", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    e.write.parquet(str(tmp_path / "in"))
    s = stream.tumbling_counts(stream.deduplicated(stream.read_events(spark, str(tmp_path / "in"), "event_id long, ts timestamp, event_type string, value double"), "event_id", "ts"), "ts", "event_type", late=None)
    q = s.writeStream.format("memory").queryName("counts").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    q = spark.table("counts")
    top = q.agg(F.max("start")).first()[0]
    batch = e.where(F.col("ts") < F.lit(top) + F.expr("interval 1 day")).groupBy(F.window("ts", "1 day").start.alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(tuple(r) for r in q.select("start", "event_type", "n").collect()) == sorted(tuple(r) for r in batch.collect())


def test_stream_merges(spark, small, tmp_path):
    e = adaptors.table(spark, small, "events").select("event_id", "value")
    e.write.parquet(str(tmp_path / "in"))
    seen = []
    q = stream.merge_batches(stream.read_events(spark, str(tmp_path / "in"), "event_id long, value double"), lambda b, i: seen.append(b.count()), str(tmp_path / "c"))
    q.awaitTermination()
    assert sum(seen) == e.count()
