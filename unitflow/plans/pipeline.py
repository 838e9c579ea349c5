"""The end-to-end run: land, conform, analyse, protect, judge, load, diff, compare, publish and verify."""

from __future__ import annotations

import argparse
import hashlib
import json
import subprocess
import sys
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitflow.functions.exprs import age_band
from unitflow.operators import analytics, changes, checks, conform, privacy
from unitflow.plans import metrics, publish
from unitflow.plans.files import Files
from unitflow.plans.orchestration import OK, Orchestrator, RunResult, Task
from unitflow.plans.store import Store
from unitflow.sources import adaptors, generate, lake

#: Keys of the published tables, checked on load.
TABLE_KEYS = {"dim_client": ["client_key"], "dim_service": ["service_key"], "dim_provider": ["provider_key"], "dim_center": ["center_key"], "dim_payer": ["payer_key"], "dim_date": ["date_key"], "fact_session": ["session_id"], "fact_authorization": ["auth_id"], "utilization": ["auth_id"]}
RELATIONSHIPS = (
    ("fact_session", "client_key", "dim_client", "client_key"), ("fact_session", "service_key", "dim_service", "service_key"), ("fact_session", "provider_key", "dim_provider", "provider_key"), ("fact_session", "center_key", "dim_center", "center_key"), ("fact_session", "date_key", "dim_date", "date_key"),
    ("fact_authorization", "client_key", "dim_client", "client_key"), ("fact_authorization", "service_key", "dim_service", "service_key"), ("fact_authorization", "payer_key", "dim_payer", "payer_key"), ("fact_authorization", "period_start_key", "dim_date", "date_key"), ("fact_authorization", "period_end_key", "dim_date", "date_key"),
)
SESSION_KEY = ["client_id", "provider_id", "service_code", "service_date", "center_id", "duration_value", "duration_uom"]
FACT_KEYS = ["date_key", "client_key", "provider_key", "center_key"]


def conformed(frames: dict[str, DataFrame], spark: SparkSession) -> dict[str, DataFrame]:
    """The star from the raw frames."""
    catalogue = adaptors.literal_rows(spark, list(generate.SERVICES), "service_code string, service_name string, discipline string, minutes_per_unit int")
    services = conform.with_unknown(conform.surrogate_keys(catalogue, ["service_code"], "service_key"), "service_key", {"service_code": "UNKNOWN", "service_name": "Unmapped", "discipline": "UNKNOWN", "minutes_per_unit": 0})
    raw, given = frames["ehr_sessions.csv"], frames["payer_authorizations.csv"]
    kept, dropped = conform.keep_first(raw, SESSION_KEY, ["session_id"])
    resolved = conform.resolve_units(kept, catalogue)
    clients = conform.scd2(frames["salesforce_clients.csv"], "client_id", "effective_date", ["payer_id"]).withColumn("age_band", age_band(F.col("age_years"))).drop("effective_date")
    clients = clients.withColumn("client_key", F.concat_ws("-", "client_id", F.col("version").cast("string")))
    providers = conform.surrogate_keys(frames["reference_providers.csv"].withColumn("is_active", F.col("term_date").isNull()), ["provider_id"], "provider_key")
    centers = conform.surrogate_keys(frames["reference_centers.csv"], ["center_id"], "center_key")
    payers = conform.surrogate_keys(frames["reference_payers.csv"], ["payer_id"], "payer_key")
    days = conform.date_bounds([(raw, "service_date"), (given, "period_start"), (given, "period_end")]).first()
    return {
        "catalogue": catalogue, "dim_service": services, "dim_client": clients, "dim_provider": providers, "dim_center": centers, "dim_payer": payers, "dim_date": conform.date_spine(spark, str(days.first_day), str(days.last_day)),
        "fact_session": conform.fact_session(resolved, clients, services, providers, centers).drop("valid_from", "valid_to"), "fact_authorization": conform.fact_authorization(given, clients, services, payers), "resolved": resolved, "dropped": dropped,
    }


def judged(star: dict[str, DataFrame], utilization: DataFrame) -> list[checks.Check]:
    facts, resolved = star["fact_session"], star["resolved"]
    lost = checks.reconciliation(resolved, facts).first().lost
    history = checks.scd2_integrity(star["dim_client"], "client_id").first()
    overlapping = analytics.overlaps(star["fact_authorization"], ["client_id", "service_code"], "period_start", "period_end", "auth_id")
    uncovered = analytics.unmatched(resolved, star["fact_authorization"])
    drop = analytics.worst_drop(analytics.coverage_by_month(resolved)).first()
    shift = checks.length_shift(resolved).first()
    counted = checks.row_counts(facts, star["fact_authorization"], star["dim_client"]).first()
    return [
        *checks.collected(checks.core_checks(resolved, utilization, star["catalogue"])),
        checks.Check("session_reconciliation", checks.BLOCK, lost == 0, lost, 0),
        checks.none_of("orphan_foreign_keys", checks.BLOCK, checks.without_member(facts, FACT_KEYS), ["session_id"], ["session_id", *FACT_KEYS]),
        checks.Check("scd_type2_integrity", checks.BLOCK, history.clients == history.current_rows and not history.overlapping, history.overlapping, 0),
        checks.none_of("overlapping_authorization_periods", checks.BLOCK, overlapping, ["auth_id"], ["auth_id", "period_start", "period_end", "prior_end"]),
        checks.none_of("duplicate_session_submissions", checks.WARN, star["dropped"], ["session_id"], ["session_id", "service_date"]),
        checks.none_of("sessions_without_authorization", checks.WARN, uncovered, ["session_id"], ["session_id", "service_date", "units"]),
        checks.Check("session_length_distribution_shift", checks.WARN, shift["shift"] <= checks.SHIFT, shift["shift"], checks.SHIFT, f"the largest move is into {shift.worst_month}" if shift.worst_month else ""),
        checks.Check("uom_coverage_step_change", checks.WARN, not (drop and drop.exceeds), drop["drop"] if drop else 0.0, checks.COVERAGE_STEP, f"the largest drop is in {drop.worst_month}" if drop else ""),
        checks.Check("row_counts", checks.INFO, True, counted.sessions, 0, ", ".join(f"{k} {v}" for k, v in counted.asDict().items())),
    ]


def diff_versions(store: Store, spark: SparkSession, before: str, after: str) -> dict[str, dict]:
    """Changes of every keyed table between two versions."""
    both = [t for t in TABLE_KEYS if t in store.tables(before) and t in store.tables(after)]
    return {t: changes.diff_summary(store.read(spark, t, before), store.read(spark, t, after), TABLE_KEYS[t]).first().asDict() for t in both}


def code_version(folder: Path = Path(__file__).parent.parent) -> str:
    """The commit that the code is of, or a digest of its files where there is none."""
    try:
        said = subprocess.run(["git", "rev-parse", "--short", "HEAD"], cwd=folder, capture_output=True, text=True, timeout=10)
        if said.returncode == 0:
            return said.stdout.strip()
    except OSError:
        pass
    return hashlib.sha256(b"".join(p.read_bytes() for p in sorted(folder.rglob("*.py")))).hexdigest()[:12]


def swap_exports(files: Files, check: Callable[[], list[str]]) -> list[str]:
    """Move exports.new to exports if ``check`` finds nothing; otherwise leave the last good exports where they are and drop the new."""
    wrong = check()
    if wrong:
        files.delete("exports.new")
        return wrong
    files.delete("exports.old")
    if files.exists("exports"):
        files.move("exports", "exports.old")
    try:
        files.move("exports.new", "exports")
    except Exception:
        if files.exists("exports.old"):
            files.move("exports.old", "exports")
        raise
    files.delete("exports.old")
    return []


def build(spark: SparkSession, root: str | Path, ingest_date: str, acknowledgements: dict[str, str] | None = None, raw: str | Path | None = None) -> list[Task]:
    run, files = uuid.uuid4().hex[:12], Files(spark, str(root))
    store, (key, salt_state) = Store(files.at("warehouse"), spark), privacy.salt()

    def extract(c):
        return {"raw": Path(raw) if raw else generate.generate(Path(tempfile.mkdtemp(prefix="unitflow-raw-")))}

    def land(c):
        backend = lake.HadoopBackend(spark, files.at("lake"))
        return {"backend": backend, "landed": lake.land(c["raw"], ingest_date, backend)}

    def read_lake(c):
        return {"frames": lake.read_lake(spark, c["backend"], ingest_date)}

    def conform_(c):
        star = conformed(c["frames"], spark)
        return {"star": star | {k: star[k].cache() for k in ("resolved", "fact_session")}}

    def analyse(c):
        s = c["star"]
        day = s["resolved"].agg(F.max("service_date")).first()[0]
        u = analytics.utilization(s["fact_authorization"], s["resolved"], s["catalogue"], F.lit(day))
        return {"as_of": day, "utilization": analytics.with_payer_and_home(u, s["dim_payer"], s["dim_client"], s["dim_center"]).cache()}

    def tables_of(c):
        return {t: c["star"][t] for t in TABLE_KEYS if t != "utilization"} | {"utilization": c["utilization"]}

    def protect(c):
        return {"findings": [f for t, df in tables_of(c).items() for f in privacy.egress_findings(privacy.deidentified(df, key, t), t)]}

    def quality(c):
        results = [*judged(c["star"], c["utilization"]), *checks.egress_checks(c["findings"]), checks.salt_check(salt_state)]
        decision = checks.gate(results, acknowledgements or {})
        files.write("quality_report.md", checks.report(results, decision))
        files.write("quality_report.json", checks.as_json(results))
        return {"results": results, "decision": decision}

    def load(c):
        before = store.pointer()
        rules = checks.ruleset_hash([x.name for x in c["results"]], list(generate.SERVICES), privacy.PATTERNS | privacy.SOURCE_IDS)
        last = store.last_logged(published=True)

        def accept(tables):
            for t, df in tables.items():
                checks.assert_unique(df, TABLE_KEYS[t])
            for fact, column, dim, natural in RELATIONSHIPS:
                if checks.orphans(tables[fact].where(F.col(column).isNotNull()).withColumnRenamed(column, natural) if column != natural else tables[fact].where(F.col(column).isNotNull()), tables[dim], natural).limit(1).count():
                    raise ValueError(f"{fact}.{column} names members that {dim} does not have")
            return c["decision"].published

        published = store.build(run, tables_of(c), accept)
        store.log(run_id=run, published=published, blocking=list(c["decision"].blocking), acknowledged=list(c["decision"].acknowledged), ruleset=rules, code_version=code_version(), backend=c["backend"].name, rows=c["star"]["fact_session"].count())
        return {"published": published, "before": before, "run": run, "rules": (last["ruleset"] if last else None, rules)}

    def diff(c):
        found = diff_versions(store, spark, c["before"], run) if c["published"] and c["before"] and c["before"] != run else None
        files.write("diff.md", changes.diff_report(found, c["rules"]))
        return {"diff": found}

    def parity(c):
        rows = metrics.parity({"sessions": c["star"]["resolved"], "utilization": c["utilization"]}).where("NOT agrees").collect()
        if rows:
            raise RuntimeError(f"two forms of a metric disagree: {[r.metric for r in rows]}")
        return {}

    def publish_(c):
        if not c["published"]:
            return {"exports": None}
        files.delete("exports.new")
        files.make("exports.new")
        u = store.read(spark, "utilization")
        publish.export_tables({t: store.read(spark, t) for t in TABLE_KEYS}, key, files.at("exports.new"))
        said = publish.payload(u, key)
        homes = u.withColumn("center_id", F.col("home_center_id"))
        for name, text in {
            "payload.json": json.dumps(said, allow_nan=False, sort_keys=True), "dashboard.html": publish.dashboard(said), "digest.md": publish.digest(homes, key), "metrics.md": metrics.catalogue_markdown(), "metrics.json": metrics.catalogue_json(),
            "relationships.json": json.dumps([dict(zip(("from_table", "from_column", "to_table", "to_column"), r, strict=True)) for r in RELATIONSHIPS]),
        }.items():
            files.write(f"exports.new/{name}", text)
        return {"exports": files.at("exports")}

    def verify(c):
        """What was written is read back before it takes the place of the last good exports."""
        if not c["exports"]:
            return {}

        def wrong():
            raw_ids = [f"{p} has {n} of {kind}" for p, kind, n in privacy.published_findings(spark, [files.at("exports.new")])]
            return publish.payload_findings(json.loads(files.read("exports.new/payload.json") or "{}"), store.read(spark, "utilization")) + raw_ids

        found = swap_exports(files, wrong)
        if found:
            if c["before"]:
                store.rollback()
            raise RuntimeError("; ".join(found))
        return {"verified": True}

    return [
        Task("extract", extract), Task("land", land, ("extract",), 2, 0.5), Task("read_lake", read_lake, ("land",)), Task("conform", conform_, ("read_lake",)), Task("analyse", analyse, ("conform",)), Task("protect", protect, ("analyse",)),
        Task("quality", quality, ("protect",)), Task("load", load, ("quality",)), Task("diff", diff, ("load",)), Task("parity", parity, ("load",)), Task("publish", publish_, ("diff", "parity")), Task("verify", verify, ("publish",)),
    ]


def run(spark: SparkSession, root: str | Path, ingest_date: str, acknowledgements: dict[str, str] | None = None, raw: str | Path | None = None) -> RunResult:
    """The events of the run go to the root where it is a local folder, else to the log of the driver's own folder."""
    local = "://" not in str(root)
    home = Path(root) if local else Path(tempfile.mkdtemp(prefix="unitflow-events-"))
    home.mkdir(parents=True, exist_ok=True)
    return Orchestrator(build(spark, root, ingest_date, acknowledgements, raw), spark, home / "events.jsonl").run()


def acknowledgement(text: str) -> tuple[str, str]:
    name, _, reason = text.partition("=")
    if len(reason.strip()) < checks.MIN_REASON:
        raise argparse.ArgumentTypeError(f"CHECK=REASON with a reason of {checks.MIN_REASON} characters or more is asked for")
    return name.strip(), reason.strip()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="unitflow")
    p.add_argument("--root", required=True)
    p.add_argument("--ingest-date", required=True)
    p.add_argument("--raw")
    p.add_argument("--acknowledge", type=acknowledgement, action="append", default=[])
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("unitflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    result = run(spark, a.root, a.ingest_date, dict(a.acknowledge), a.raw)
    print(result.timing_table())
    return 0 if all(r.status == OK for r in result.runs) and result.context.get("published") else 1


if __name__ == "__main__":
    sys.exit(main())
