"""Operators on hand-made rows: what the oracles at scale do not pin down."""

import hashlib
import hmac
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from unitflow.functions import exprs
from unitflow.operators import analytics, changes, checks, conform, privacy

D = date.fromisoformat


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame([("97153", 15), ("97155", 45)], "service_code string, minutes_per_unit int")


def test_units_are_resolved_or_explained(spark, catalogue):
    rows = [(1, "97153", "60", "minutes"), (2, "97153", "4", " Units "), (3, "97153", "60", None), (4, "99999", "60", "minutes"), (5, "97153", "n/a", "minutes"), (6, "97155", "90", "MINUTES"), (7, "97153", "60", "hours"), (8, "99999", "10d", None), (9, "97153", "NaN", "units"), (10, None, "1", "units")]
    df = spark.createDataFrame(rows, "id int, service_code string, duration_value string, duration_uom string")
    got = {r.id: (r.minutes, r.units, r.unresolved_reason) for r in conform.resolve_units(df, catalogue).collect()}
    assert got[1] == (60.0, 4.0, None)
    assert got[2] == (60.0, 4.0, None)
    assert got[3] == (0.0, 0.0, "missing_uom")
    assert got[4][2] == got[10][2] == "unmapped_service_code"
    assert got[5][2] == got[8][2] == got[9][2] == "non_numeric_duration"
    assert got[6] == (90.0, 2.0, None)
    assert got[7][2] == "unrecognised_uom"
    naive = {r.id: r.minutes_naive for r in conform.resolve_units_naive(df, catalogue).collect()}
    assert naive[3] == 60.0
    assert naive[2] == 60.0


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(2, "a", None), (1, "a", None), (3, "b", None)], "id int, k string, u string")
    kept, dropped = conform.keep_first(df, ["k", "u"], ["id"])
    assert sorted(r.id for r in kept.collect()) == [1, 3]
    assert [r.id for r in dropped.collect()] == [2]


def test_history_and_as_of(spark):
    ch = spark.createDataFrame([("C1", D("2026-01-01"), "P1"), ("C1", D("2026-03-01"), "P2"), ("C2", D("2026-01-01"), "P3")], "client_id string, d date, payer_id string")
    v = conform.scd2(ch, "client_id", "d", ["payer_id"])
    got = {(r.client_id, r.version): (r.valid_from, r.valid_to, r.is_current) for r in v.collect()}
    assert got["C1", 1] == (D("2026-01-01"), D("2026-02-28"), False)
    assert got["C1", 2] == (D("2026-03-01"), D("9999-12-31"), True)
    facts = spark.createDataFrame([(1, "C1", D("2026-02-28")), (2, "C1", D("2026-03-01")), (3, "C1", D("2025-12-31")), (4, "C9", D("2026-03-01"))], "id int, client_id string, on date")
    vv = v.select("client_id", "version", "payer_id", "valid_from", "valid_to")
    assert {r.id: r.payer_id for r in conform.as_of(facts, vv, "client_id", "on").collect()} == {1: "P1", 2: "P2"}
    either = {r.id: (r.payer_id, r.in_window) for r in conform.as_of_or_earliest(facts, vv, "client_id", "on", "id").collect()}
    assert either == {1: ("P1", True), 2: ("P2", True), 3: ("P1", False), 4: (None, False)}
    assert checks.scd2_integrity(v, "client_id").first().overlapping == 0


def auths_and_sessions(spark, units=(10.0,) * 4, authorized=100.0):
    a = spark.createDataFrame([("A1", "C1", "97153", authorized, D("2026-01-01"), D("2026-04-10"))], "auth_id string, client_id string, service_code string, units_authorized double, period_start date, period_end date")
    rows = [(i, "C1", "97153", D(f"2026-01-{i + 1:02d}"), "completed", True, u, u * 15) for i, u in enumerate(units)]
    return a, spark.createDataFrame(rows, "session_id int, client_id string, service_code string, service_date date, status string, uom_resolved boolean, units double, minutes double")


def test_utilization_pace_and_null_ratios(spark, catalogue):
    a, s = auths_and_sessions(spark)
    u = analytics.utilization(a, s, catalogue, F.lit("2026-02-19").cast("date")).first()
    assert (u.utilization, u.elapsed_days, u.elapsed_fraction, u.pace) == (0.4, 50, 0.5, 0.8)
    assert (u.units_unused, u.hours_unused) == (60.0, 15.0)
    u = analytics.utilization(*auths_and_sessions(spark, authorized=0.0), catalogue, F.lit("2026-02-19").cast("date")).first()
    assert u.utilization is None
    assert u.pace is None
    over = analytics.utilization(*auths_and_sessions(spark, authorized=10.0), catalogue, F.lit("2027-01-01").cast("date")).first()
    assert (over.units_unused, over.performance) == (0.0, 4.0)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 40), min_size=1, max_size=12))
def test_roll_up_is_additive(spark, units):
    a, s = auths_and_sessions(spark, [float(u) for u in units])
    whole = analytics.roll_up(a, s).first().units_delivered
    assert whole == sum(units)
    parts = [analytics.roll_up(a, s.where(F.col("session_id") % 2 == k)).first().units_delivered for k in (0, 1)]
    assert sum(parts) == whole


@pytest.mark.parametrize(("units", "want"), [
    ((0.1, 0.2), 0.3), ((0.43, 0.93, 2.06, 3.58), 7.0), ((0.1,) * 10, 1.0), ((1 / 45,) * 9, 0.2), ((-0.1, 0.3, -0.2), 0.0),
    ((0.0,), 0.0), ((1e-7, 2e-7), 3e-7), ((1e300, 1.0), 1e300), ((float("inf"), 1.0), float("inf")), ((123456789.12, 0.01), 123456789.13), ((1e15, 0.5), 1e15 + 0.5), ((2.0**53 - 2, 1.0), 2.0**53 - 1),
])
def test_roll_up_sums_what_the_units_sum_to(spark, units, want):
    for order in (units, units[::-1]):
        a, s = auths_and_sessions(spark, order)
        assert analytics.roll_up(a, s).first().units_delivered == want


def test_overlaps_see_past_the_last_row(spark):
    p = spark.createDataFrame([(1, "a", 1, 100), (2, "a", 5, 6), (3, "a", 50, 60), (4, "b", 1, 2), (5, "b", 3, 4)], "id int, k string, s int, e int")
    assert sorted(r.id for r in analytics.overlaps(p, ["k"], "s", "e", "id").collect()) == [2, 3]


@pytest.mark.parametrize("key", [b"k", b"x" * 100])
def test_pseudonyms_are_hmac(spark, key):
    df = spark.createDataFrame([("CLI-00001",), (None,)], "v string")
    got = [r[0] for r in df.select(exprs.pseudonym(F.col("v"), key, "CLI")).collect()]
    assert got == ["CLI-" + hmac.new(key, b"CLI-00001", hashlib.sha256).hexdigest()[:12].upper(), ""]


def test_expressions(spark):
    df = spark.createDataFrame([(" \tMin utes\n", "1e3", 0.0, None)], "a string, b string, z double, n double")
    r = df.select(exprs.normalised(F.col("a")).alias("a"), exprs.number(F.col("b")).alias("b"), exprs.ratio(F.col("b").cast("double"), F.col("z")).alias("c"), exprs.clipped(F.col("n"), 0, 1).alias("d"), exprs.masked(F.lit("abcdefgh")).alias("e"), exprs.masked(F.lit("abc")).alias("f")).first()
    assert tuple(r) == ("min utes", 1000.0, None, None, "ab…gh", "…")


def test_scan_finds_shapes_and_hides_them(spark):
    df = spark.createDataFrame([("call (555) 123-4567", 1), ("mail a.b@c.org", 2), ("SSN 123-45-6789", 3), ("member rather", 4), ("Member ID 99182773", 5), ("float 106728.6875", 6), (None, 7)], "t string, n int")
    hits = {(r["column"], r.pattern): (r.matches, r.example) for r in privacy.scan(df).collect()}
    assert {p for _, p in hits} == {"phone_us", "email", "ssn", "member_id_like"}
    assert hits["t", "email"] == (1, "a.…rg")


def counts(spark, values):
    return spark.createDataFrame([(chr(97 + i), v) for i, v in enumerate(values)], "label string, n long")


def test_suppression(spark):
    show = lambda df: {r.label: r.n for r in df.collect()}
    assert show(privacy.suppress(counts(spark, [5, 50, 20]), "n", "label")) == {"a": "<11", "b": "50", "c": "<11"}
    assert show(privacy.suppress(counts(spark, [5, 50, 0]), "n", "label")) == {"a": "<11", "b": "50", "c": "<11"}
    assert show(privacy.suppress(counts(spark, [5, 50]), "n", "label", total_is_published=False)) == {"a": "<11", "b": "50"}
    assert show(privacy.suppress(counts(spark, [11, 0, None]), "n", "label")) == {"a": "11", "b": "0", "c": None}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 40), min_size=1, max_size=8))
def test_suppression_never_leaves_one_hidden_cell(spark, values):
    out = privacy.suppress(counts(spark, values), "n", "label")
    assert privacy.disclosive(out, "n").count() == 0
    hidden = out.where("suppressed").count()
    assert hidden != 1 or len(values) == 1


def test_egress(spark):
    df = spark.createDataFrame([("CLI-0123456789AB", "45", "x")], "client_id string, service_code string, mystery string")
    assert privacy.egress_findings(df, "utilization") == [("utilization", "mystery", "undeclared")]
    assert len(privacy.egress_findings(df, "no_such_table")) == 3
    raw = spark.createDataFrame([("CLI-00001", "a@b.org")], "client_id string, service_code string")
    assert {f[2] for f in privacy.egress_findings(raw, "utilization")} == {"unpseudonymised_identifier", "content_match:email"}
    assert privacy.egress_findings(privacy.deidentified(raw.drop("service_code"), b"k", "utilization"), "utilization") == []
    both = checks.egress_checks([("t", "c", "undeclared"), ("t", "d", "content_match:email")])
    assert [(c.name, c.passed, c.acknowledgeable) for c in both] == [("phi_egress", False, False), ("phi_content_scan", False, True)]


def test_samples_and_published_text_show_no_identifier(spark, tmp_path):
    shown = privacy.redact_records([{"client_id": "CLI-00001", "note": "see SES-0000012", "n": 3, "auth_id": None}])[0]
    assert shown["client_id"].startswith("CLI-") and shown["client_id"] != "CLI-00001"
    assert (shown["note"], shown["n"], shown["auth_id"]) == ("see [redacted]", 3, None)
    (tmp_path / "a.txt").write_text("CLI-00001 and PRV-0007\nCLI-00002")
    assert sorted(x[1:] for x in privacy.published_findings(spark, [str(tmp_path)])) == [("raw_client_id", 2), ("raw_provider_id", 1)]
    df = spark.createDataFrame([("a CLI-00001 b",)], "t string").select(privacy.redacted(F.col("t")).alias("t"))
    assert df.first().t == "a [redacted] b"


@pytest.mark.parametrize(("state", "severity", "passed"), [("configured", "BLOCK", True), ("development", "BLOCK", False), ("ephemeral", "WARN", False)])
def test_salt_states(state, severity, passed):
    c = checks.salt_check(state)
    assert (c.severity, c.passed) == (severity, passed)
    assert not checks.gate([c], {c.name: "we accept a salt like this"}).published or severity == "WARN" or passed


def test_findings_show_their_first_rows(spark):
    facts = spark.createDataFrame([(f"SES-{i:07d}", None if i % 2 else i) for i in range(20)], "session_id string, center_key int")
    c = checks.none_of("orphan_foreign_keys", checks.BLOCK, checks.without_member(facts, ["center_key"]), ["session_id"], ["session_id", "center_key"])
    assert (c.passed, c.observed, len(c.sample)) == (False, 10, 5)
    assert all(not r["session_id"].startswith("SES-000") for r in c.sample)
    assert "orphan_foreign_keys" in checks.report([c], checks.gate([c], {}))


def test_payers_with_two_contracts_make_no_second_row(spark):
    u = spark.createDataFrame([("A1", "c1", "p1"), ("A2", "c2", None)], "auth_id string, client_id string, payer_id string")
    payers = spark.createDataFrame([("p1", "One", "value_based"), ("p1", "One", "fee_for_service")], "payer_id string, payer_name string, contract_type string")
    clients = spark.createDataFrame([("c1", "h1", False), ("c1", "h2", True)], "client_id string, home_center_id string, is_current boolean")
    centers = spark.createDataFrame([("h2", "Two")], "center_id string, center_name string")
    rows = analytics.with_payer_and_home(u, payers, clients, centers).orderBy("auth_id").collect()
    assert [(r.auth_id, r.contract_type, r.center_name) for r in rows] == [("A1", "fee_for_service", "Two"), ("A2", None, None)]


def test_reports_of_changes():
    assert "no earlier build" in changes.diff_report(None)
    d = {"t": {"added": 1, "removed": 0, "changed": 2, "unchanged": 3, "changed_a": 2, "changed_b": 0}}
    text = changes.diff_report(d, ("x", "y"))
    assert "3 rows differ" in text and "a (2)" in text and "The rules changed" in text
    assert "The rules changed" not in changes.diff_report(d, (None, "y"))


def test_diff_counts_nulls_as_equal(spark):
    b = spark.createDataFrame([(1, None, 1), (2, "x", 2), (3, "y", 3)], "id int, s string, n int")
    a = spark.createDataFrame([(1, None, 1.0), (2, "z", 2.0), (4, "y", 3.0)], "id int, s string, n double")
    r = changes.diff_summary(b, a, ["id"]).first()
    assert (r.added, r.removed, r.changed, r.unchanged, r.changed_s, r.changed_n) == (1, 1, 1, 1, 1, 0)
    same = changes.diff_summary(b, b, ["id"]).first()
    assert (same.added, same.removed, same.changed) == (0, 0, 0)
    with pytest.raises(ValueError, match="no key"):
        changes.diff_summary(b, a, ["nope"])


def test_gate():
    bad = checks.Check("duration_plausibility", checks.BLOCK, False, 3, 0)
    egress = checks.Check("phi_egress", checks.BLOCK, False, 1, 0)
    assert not checks.gate([bad], {}).published
    assert not checks.gate([bad], {"duration_plausibility": "short"}).published
    ok = checks.gate([bad], {"duration_plausibility": "known device fault in May"})
    assert ok.published
    assert ok.acknowledged == ("duration_plausibility",)
    refused = checks.gate([egress], {"phi_egress": "we accept the risk of this"})
    assert not refused.published
    assert refused.refused == ("phi_egress",)
    assert checks.ruleset_hash(["a"], [("x", 1)], {}) != checks.ruleset_hash(["a"], [("x", 2)], {})


def test_unique_and_orphans(spark):
    with pytest.raises(ValueError, match="not unique"):
        checks.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    assert checks.orphans(spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int"), "k").count() == 1


def test_unknown_member(spark):
    dim = conform.with_unknown(spark.createDataFrame([(1, "a")], "service_key int, service_code string"), "service_key", {"service_code": "UNKNOWN"})
    facts = conform.lookup(spark.createDataFrame([("a",), ("b",), (None,)], "service_code string"), dim, "service_code", ["service_key"], {"service_key": 0})
    assert sorted(r.service_key for r in facts.collect()) == [0, 0, 1]
