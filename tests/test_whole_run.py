"""The whole run over generated extracts: the gate, the pointer, reruns and what is published."""

import json
import re

import pytest

from unitflow.operators import changes
from unitflow.plans import pipeline
from unitflow.plans.store import Store

REASON = {"uom_resolution_coverage": "the vendor dropped the unit field in spring", "duration_plausibility": "known short visits of this clinic"}


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    return root, [pipeline.run(spark, root, "2026-05-01", a) for a in ({}, REASON, REASON)]


def test_blocked_without_and_published_with_a_reason(runs):
    root, (blocked, first, second) = runs
    assert [r.failed_task for r in (blocked, first, second)] == [None] * 3, [x.error for r in (blocked, first, second) for x in r.runs if x.error]
    assert not blocked.context["published"]
    assert "uom_resolution_coverage" in blocked.context["decision"].blocking
    assert first.context["published"]
    assert second.context["verified"]
    assert Store(root / "warehouse").pointer() == second.context["run"]
    assert "published" in (root / "quality_report.md").read_text()


def test_a_rerun_changes_nothing(spark, runs):
    root, (_, first, second) = runs
    s = Store(root / "warehouse")
    assert all(d["added"] == d["removed"] == d["changed"] == 0 for d in second.context["diff"].values())
    for t in ("fact_session", "utilization"):
        assert changes.fingerprint(s.read(spark, t, first.context["run"])).first() == changes.fingerprint(s.read(spark, t)).first()
    assert s.run_log(spark).count() == 3


def test_what_is_published_has_no_raw_identifier(runs):
    root, _ = runs
    text = "".join(p.read_text() for p in (root / "exports").rglob("*") if p.is_file() and p.suffix in (".csv", ".json", ".md"))
    # by shape: a pseudonym may begin with zeros by chance
    assert not re.search(r"\b(CLI-\d{4,6}|AUTH-\d{5,7}|PRV-\d{3,5}|SES-\d{6,8})\b", text)
    assert json.loads((root / "exports" / "payload.json").read_text())["headline"]["open_auths"] > 0
    assert len(json.loads((root / "exports" / "relationships.json").read_text())) == 10
    assert {p.name for p in (root / "exports").iterdir() if p.is_dir()} == set(pipeline.TABLE_KEYS)
    assert (root / "exports" / "dashboard.html").exists()
    assert "No row differs" in (root / "diff.md").read_text()


def test_the_star_spans_all_days_and_has_all_keys(spark, runs):
    root, (_, first, _) = runs
    s = Store(root / "warehouse")
    days = s.read(spark, "dim_date").selectExpr("min(full_date)", "max(full_date)").first()
    facts, auths = s.read(spark, "fact_session"), s.read(spark, "fact_authorization")
    sessions = facts.selectExpr("min(service_date)", "max(service_date)").first()
    periods = auths.selectExpr("min(period_start)", "max(period_end)").first()
    assert days[0] == min(sessions[0], periods[0])
    assert days[1] == max(sessions[1], periods[1])
    assert facts.where("date_key IS NULL OR client_key IS NULL OR provider_key IS NULL OR center_key IS NULL").count() == 0
    assert auths.where("payer_key IS NULL").count() == 0
    names = {c.name for c in first.context["results"]}
    assert {"orphan_foreign_keys", "sessions_without_authorization", "session_length_distribution_shift", "phi_content_scan", "pseudonym_salt_configured", "row_counts"} <= names
    assert len(names) == 17
    log = s.run_log(spark)
    assert log.where("code_version IS NULL OR ruleset IS NULL").count() == 0


def test_acknowledgements_need_reasons():
    with pytest.raises(Exception, match="CHECK=REASON"):
        pipeline.acknowledgement("x=short")
    assert pipeline.acknowledgement("x=a good long reason") == ("x", "a good long reason")
