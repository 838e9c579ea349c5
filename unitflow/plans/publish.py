"""Sinks: CSV exports, a JSON payload and a weekly digest, with small cells suppressed at the door."""

from __future__ import annotations

import hmac
import json
import math
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitflow.operators import analytics, privacy

ROWS, DIGEST_ROWS = 25, 12


def for_csv(df: DataFrame) -> DataFrame:
    """Booleans as 0 and 1, dates as ISO text."""
    kinds = {"boolean": lambda c: F.col(c).cast("int"), "date": lambda c: F.date_format(c, "yyyy-MM-dd")}
    return df.select(*[kinds[t](c).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


def export_csv(df: DataFrame, path: str) -> None:
    for_csv(df).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def json_safe(v):
    """NaN and infinities become null, at any depth."""
    if isinstance(v, dict):
        return {k: json_safe(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [json_safe(x) for x in v]
    if isinstance(v, float) and not math.isfinite(v):
        return None
    return v.isoformat() if hasattr(v, "isoformat") else v


def shown(n: int | None) -> int | str | None:
    return privacy.MARK if n is not None and 0 < n <= privacy.THRESHOLD else n


def export_tables(tables: dict[str, DataFrame], key: bytes, path: str) -> dict[str, list[tuple[str, str, str]]]:
    """Every table as CSV below ``path``, by pseudonym and in a fixed order; and what its egress check found. A table with findings is not written."""
    found = {}
    for name, df in tables.items():
        safe = privacy.deidentified(df, key, name)
        found[name] = privacy.egress_findings(safe, name)
        if not found[name]:
            export_csv(safe.orderBy(*safe.columns[:1]), f"{path}/{name}")
    return found


def payload(u: DataFrame, key: bytes) -> dict:
    """Headline and the authorisations most at risk, ROWS at most, by pseudonym and without their centre."""
    h = analytics.headline(u).first().asDict()
    h["clients_at_risk"] = shown(h["clients_at_risk"])
    top = analytics.at_risk(u).orderBy("days_to_expiry", F.col("hours_unused").desc(), "auth_id").limit(ROWS)
    safe = privacy.deidentified(top.select("auth_id", "client_id", "service_code", "units_authorized", "units_delivered", "hours_unused", "period_end"), key, "utilization")
    return json_safe({"headline": h, "at_risk": [r.asDict() for r in safe.collect()]})


def write_payload(p: dict, path: str | Path) -> None:
    Path(path).write_text(json.dumps(p, allow_nan=False, sort_keys=True))


def verify_payload(path: str | Path, u: DataFrame, tolerance: float = 1e-6) -> list[str]:
    return payload_findings(json.loads(Path(path).read_text() or "{}"), u, tolerance)


def payload_findings(p: dict, u: DataFrame, tolerance: float = 1e-6) -> list[str]:
    """What the published headline says that the data do not; an empty payload is a finding."""
    if not p.get("headline"):
        return ["the payload has no headline"]
    own = json_safe(analytics.headline(u).first().asDict())
    own["clients_at_risk"] = shown(own["clients_at_risk"])
    same = lambda a, b: a == b or (isinstance(a, (int, float)) and isinstance(b, (int, float)) and abs(a - b) <= tolerance)
    return [f"{k}: {p['headline'].get(k)} is published, {v} is true" for k, v in own.items() if not same(p["headline"].get(k), v)]


def plan_centres(risk: DataFrame, centre: str = "center_id") -> DataFrame:
    """Clients at risk by centre with small centres (and one more, if a single one could be told by subtraction) pooled."""
    n = risk.groupBy(centre).agg(F.countDistinct("client_id").alias("clients"), F.sum("hours_unused").alias("hours"), F.count(F.lit(1)).alias("authorizations"))
    return privacy.suppress(n, "clients", centre, derived=("hours", "authorizations"))


def sections(risk: DataFrame, centre: str = "center_id") -> DataFrame:
    """The rows of ``risk`` with ``section``: their centre, or null where the centre is pooled or unknown."""
    open_ = plan_centres(risk, centre).where("NOT suppressed").select(F.col(centre).alias("section"))
    return risk.join(open_, risk[centre] == F.col("section"), "left")


def digest_rows(risk: DataFrame, centre: str = "center_id", limit: int = DIGEST_ROWS) -> DataFrame:
    """section, rank, auth_id, client_id, service_code, hours_unused, days_to_expiry, more: the first rows of each section, by expiry so that no order tells a pooled centre."""
    rows = analytics.first_rows(sections(risk, centre), "section", [F.col("days_to_expiry"), F.col("hours_unused").desc(), F.col("auth_id")], limit)
    return rows.select("section", "rank", "auth_id", "client_id", "service_code", "hours_unused", "days_to_expiry", "more")


def digest(u: DataFrame, key: bytes) -> str:
    """The weekly text: totals, then a table a centre; small centres share one without their names.

    Where the pooled clients are few, the totals are withheld too: less the named centres they would tell the number.
    """
    risk = analytics.at_risk(u)
    h = analytics.headline(u).first()
    plan = {r.center_id: r for r in plan_centres(risk).collect()}
    pooled = sections(risk).where("section IS NULL").agg(F.countDistinct("client_id").alias("n")).first().n
    hidden = 0 < pooled <= privacy.THRESHOLD
    total = "The total is withheld, as it would tell a small number." if hidden else f"{shown(h.clients_at_risk)} clients with {h.at_risk} authorisations and {h.hours_at_risk or 0:,.0f} hours at risk."
    lines = ["# Weekly digest", "", total, ""]
    rows: dict = {}
    for r in digest_rows(risk).orderBy("section", "rank").collect():  # DIGEST_ROWS a centre at most
        rows.setdefault(r.section, []).append(r)
    for section in sorted(rows, key=lambda s: (s is None, s)):
        own = plan.get(section)
        head = f"Centre {section}: {own.clients} clients, {float(own.hours):,.0f} hours" if section is not None else f"{sum(r.suppressed for r in plan.values()) or 'Other'} centres with few clients: {shown(pooled)} clients"
        lines += [f"## {head}", "", "| client | service | hours left | days left |", "|---|---|---:|---:|"]
        lines += [f"| {_pseudonym(r.client_id, key)} | {r.service_code} | {r.hours_unused:,.1f} | {r.days_to_expiry} |" for r in rows[section]]
        more = rows[section][0].more
        lines += [f"| ... | {more} more | | |"] if more else []
        lines.append("")
    return "\n".join(lines).strip() + "\n"


def _pseudonym(value, key: bytes) -> str:
    return f"{privacy.PREFIXES['client_id']}-{hmac.new(key, str(value).encode(), 'sha256').hexdigest()[:12].upper()}"


PAGE = """<!doctype html><meta charset="utf-8"><title>Utilisation</title>
<h1>Utilisation of authorised units</h1><dl id="headline"></dl><table id="risk"></table>
<script id="data" type="application/json">%s</script>
<script>
const data = JSON.parse(document.getElementById("data").textContent);
const add = (parent, tag, text) => parent.appendChild(Object.assign(document.createElement(tag), {textContent: text ?? "-"}));
for (const [name, value] of Object.entries(data.headline)) { add(headline, "dt", name); add(headline, "dd", value); }
if (data.at_risk.length) {
  const names = Object.keys(data.at_risk[0]), head = risk.createTHead().insertRow(), body = risk.createTBody();
  names.forEach(n => add(head, "th", n));
  data.at_risk.forEach(r => { const row = body.insertRow(); names.forEach(n => add(row, "td", r[n])); });
}
</script>
"""


def dashboard(p: dict) -> str:
    """One HTML page that holds the payload; no text in it can end the script early."""
    return PAGE % json.dumps(p, allow_nan=False, sort_keys=True).replace("</", "<\\/")
