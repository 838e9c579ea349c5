"""Quality checks, the publication gate and the fingerprint of the rules."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unitflow.operators import privacy

BLOCK, WARN, INFO = "BLOCK", "WARN", "INFO"
COVERAGE_FLOOR, COVERAGE_STEP, SHIFT, MIN_MINUTES, MAX_MINUTES, CEILING, MIN_REASON = 0.99, 0.02, 0.40, 5, 480, 1.00, 10
SAMPLE = 5
VERSION = "2"
NOT_ACKNOWLEDGEABLE = frozenset({"phi_egress", "pseudonym_salt_configured"})


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    passed: bool
    observed: float
    threshold: float
    message: str = ""
    sample: tuple = ()

    @property
    def acknowledgeable(self) -> bool:
        return self.name not in NOT_ACKNOWLEDGEABLE


@dataclass(frozen=True)
class Decision:
    published: bool
    blocking: tuple[str, ...]
    acknowledged: tuple[str, ...]
    refused: tuple[str, ...] = field(default_factory=tuple)


def core_checks(resolved: DataFrame, utilization: DataFrame, catalogue: DataFrame, code: str = "service_code") -> DataFrame:
    """name, severity, passed, observed, threshold: one aggregate over each table. A code is unmapped if ``catalogue`` does not have it."""
    bad = F.expr("status = 'completed' AND uom_resolved") & ~F.col("minutes").between(MIN_MINUTES, MAX_MINUTES)
    # a code can be unmapped behind another reason, so the catalogue is asked
    known = catalogue.select(F.col(code).cast("string").alias("_code")).distinct().withColumn("_known", F.lit(True))
    asked = resolved.join(known, F.col(code).cast("string") == F.col("_code"), "left")
    a = asked.agg(F.coalesce(F.avg(F.col("uom_resolved").cast("double")), F.lit(1.0)).alias("coverage"), F.count_if(bad).alias("implausible"), F.count_if(F.col("_known").isNull()).alias("unmapped"))
    u = utilization.agg(F.count_if(F.col("utilization") > CEILING).alias("over"), F.count_if((F.col("units_authorized") == 0) & (F.col("units_delivered") > 0)).alias("zero"))
    row = lambda name, severity, passed, observed, threshold: F.struct(F.lit(name).alias("name"), F.lit(severity).alias("severity"), passed.alias("passed"), observed.cast("double").alias("observed"), F.lit(float(threshold)).alias("threshold"))
    none = lambda name, severity, c: row(name, severity, F.col(c) == 0, F.col(c), 0)
    rows = [
        row("uom_resolution_coverage", BLOCK, F.col("coverage") >= COVERAGE_FLOOR, F.col("coverage"), COVERAGE_FLOOR),
        none("duration_plausibility", BLOCK, "implausible"), none("unmapped_service_codes", WARN, "unmapped"), none("utilization_over_ceiling", WARN, "over"), none("zero_unit_authorizations", WARN, "zero"),
    ]
    one = a.crossJoin(F.broadcast(u))  # one row each
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def sampled(rows: DataFrame, order: list[str], columns: list[str], n: int = SAMPLE) -> tuple[dict, ...]:
    """The first ``n`` rows of a finding as dictionaries, without raw identifiers."""
    return tuple(privacy.redact_records([r.asDict() for r in rows.orderBy(*order).select(*columns).limit(n).collect()]))


def none_of(name: str, severity: str, rows: DataFrame, order: list[str], columns: list[str]) -> Check:
    """A check that passes where ``rows`` is empty; otherwise it shows the first of them."""
    n = rows.count()
    return Check(name, severity, n == 0, n, 0, sample=sampled(rows, order, columns) if n else ())


def without_member(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Facts with a null in one of the keys."""
    return facts.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def exposure(unmatched: DataFrame) -> DataFrame:
    """One row: sessions that no authorisation covers, and their units."""
    return unmatched.agg(F.count(F.lit(1)).alias("sessions"), F.coalesce(F.sum("units"), F.lit(0.0)).alias("units"))


def length_shift(sessions: DataFrame) -> DataFrame:
    """One row: the month into which the median length of completed, resolved sessions moved most, and by how much; 0 with fewer than two months."""
    done = sessions.where("status = 'completed' AND uom_resolved").withColumn("year_month", F.date_format("service_date", "yyyy-MM"))
    median = done.groupBy("year_month").agg(F.median("minutes").alias("minutes"))
    before = F.lag("minutes").over(Window.orderBy("year_month"))  # one row a month
    moves = median.withColumn("shift", F.coalesce(F.abs(F.try_divide(F.col("minutes"), before) - 1), F.lit(0.0)))
    top = F.max(F.struct("shift", "year_month"))
    return moves.agg(F.when(F.count(F.lit(1)) >= 2, top.getField("year_month")).alias("worst_month"), F.when(F.count(F.lit(1)) >= 2, top.getField("shift")).otherwise(0.0).alias("shift"))


def row_counts(facts: DataFrame, auths: DataFrame, clients: DataFrame) -> DataFrame:
    """One row: sessions, authorisations, clients and their versions."""
    one = lambda df, *c: df.agg(*c)
    n = F.count(F.lit(1))
    out = one(facts, n.alias("sessions")).crossJoin(F.broadcast(one(auths, n.alias("authorizations"))))
    return out.crossJoin(F.broadcast(one(clients, F.countDistinct("client_id").alias("clients"), n.alias("client_versions"))))  # one row each


def salt_check(state: str) -> Check:
    """Where the salt came from decides: a known constant can be reversed, a salt of one run can only not be joined with another run."""
    severity = WARN if state == "ephemeral" else BLOCK
    said = {"configured": "a salt is configured", "development": "the salt is the constant in the code: pseudonyms can be reversed", "ephemeral": "the salt is this run's own: pseudonyms of two runs differ"}
    return Check("pseudonym_salt_configured", severity, state == "configured", float(state != "configured"), 0, said[state], ({"salt": state},))


def egress_checks(findings: list[tuple[str, str, str]]) -> list[Check]:
    """Proof (raw or undeclared columns) and guesses (contents of an identifier's shape) apart: only the second can be acknowledged."""
    guesses = [f for f in findings if f[2].startswith("content_match:")]
    proof = [f for f in findings if f not in guesses]
    shown = lambda own: tuple({"table": t, "column": c, "reason": w} for t, c, w in own[:SAMPLE])
    return [Check("phi_egress", BLOCK, not proof, len(proof), 0, sample=shown(proof)), Check("phi_content_scan", BLOCK, not guesses, len(guesses), 0, sample=shown(guesses))]


def scd2_integrity(versions: DataFrame, key: str) -> DataFrame:
    """One row: keys, current rows (as many as keys if sound), versions that reach into the next, and versions of no day."""
    nxt = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from", "version"))
    v = versions.withColumn("_next", nxt)
    return v.agg(F.countDistinct(key).alias("clients"), F.count_if("is_current").alias("current_rows"), F.count_if(F.col("valid_to") >= F.col("_next")).alias("overlapping"), F.count_if(F.col("valid_to") < F.col("valid_from")).alias("empty"))


def reconciliation(sessions: DataFrame, facts: DataFrame) -> DataFrame:
    """One row: sessions, facts, and how many the as-of join lost."""
    a, b = sessions.agg(F.count(F.lit(1)).alias("sessions")), facts.agg(F.count(F.lit(1)).alias("facts"))
    return a.crossJoin(F.broadcast(b)).withColumn("lost", F.col("sessions") - F.col("facts"))  # one row each


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key no member has."""
    return facts.join(dim.select(key), key, "left_anti")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{', '.join(keys)} is not unique: {twice[0].asDict()}")


def collected(rows: DataFrame) -> list[Check]:
    return [Check(r["name"], r.severity, r.passed, r.observed, r.threshold) for r in rows.collect()]


def gate(results: list[Check], acknowledgements: dict[str, str]) -> Decision:
    """Published unless a blocking check failed without a written, acceptable reason."""
    failed = [c for c in results if c.severity == BLOCK and not c.passed]
    ok = {c.name for c in failed if c.acknowledgeable and len(acknowledgements.get(c.name, "").strip()) >= MIN_REASON}
    left = tuple(c.name for c in failed if c.name not in ok)
    return Decision(not left, left, tuple(sorted(ok)), tuple(sorted(set(acknowledgements) - ok)))


def ruleset_hash(names: list[str], catalogue: list[tuple], patterns: dict[str, str]) -> str:
    """Changes when a rule, a threshold, a unit or a pattern changes."""
    spec = {"version": VERSION, "checks": names, "thresholds": [COVERAGE_FLOOR, COVERAGE_STEP, SHIFT, MIN_MINUTES, MAX_MINUTES, CEILING], "units": catalogue, "patterns": patterns}
    return hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()[:16]


def report(results: list[Check], decision: Decision) -> str:
    head = "published" if decision.published else f"blocked by {', '.join(decision.blocking)}"
    rows = [f"| {c.name} | {c.severity} | {'pass' if c.passed else 'FAIL'} | {c.observed:g} | {c.threshold:g} |" for c in results]
    examples = [f"- {c.name}: {c.message or json.dumps(list(c.sample), default=str)}" for c in results if not c.passed and (c.message or c.sample)]
    return "\n".join([f"# Quality report: {head}", "", "| check | severity | result | observed | threshold |", "|---|---|---|---:|---:|", *rows, "", *examples, ""])


def as_json(results: list[Check]) -> str:
    return json.dumps([asdict(c) for c in results], allow_nan=False, default=str)
