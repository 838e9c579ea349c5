"""Seeded synthetic extracts with the defects that the checks must find. A test-data tool: plain Python, bounded by its arguments."""

from __future__ import annotations

import csv
import random
from datetime import date, timedelta
from pathlib import Path

#: Service codes, minutes of a unit.
SERVICES = (("97151", "Assessment", "ABA", 15), ("97153", "Direct therapy", "ABA", 15), ("97155", "Supervision", "ABA", 15), ("92507", "Speech session", "SLP", 45), ("97530", "Occupational", "OT", 15))


def rows_to(path: Path, names: list[str], rows: list[tuple]) -> None:
    with path.open("w", newline="") as f:
        w = csv.writer(f)
        w.writerow(names)
        w.writerows(rows)


def generate(out: str | Path, seed: int = 7, clients: int = 40, days: int = 120, start: date = date(2026, 1, 1), defect_share: float = 0.2) -> Path:
    """Six CSV files. From the middle of the span on, ``defect_share`` of the sessions lack their unit; some are repeated, and some codes are unknown."""
    r, out = random.Random(seed), Path(out)
    out.mkdir(parents=True, exist_ok=True)
    centers = [(f"CTR-{i}", f"Centre {i}", "WA" if i % 2 else "OR") for i in range(4)]
    payers = [(f"PAY-{i}", f"Payer {i}", "value_based" if i % 2 else "fee_for_service") for i in range(3)]
    providers = [(f"PRV-{i:04d}", r.choice(["lead", "staff"]), r.choice(["ABA", "SLP", "OT"]), r.choice(centers)[0], start - timedelta(days=r.randint(30, 900)), "" if r.random() < 0.9 else start + timedelta(days=30)) for i in range(20)]
    people, changes, auths, sessions = [f"CLI-{i:05d}" for i in range(clients)], [], [], []
    for p in people:
        payer = r.choice(payers)[0]
        age, home = r.randint(2, 14), r.choice(centers)[0]
        changes.append((p, start - timedelta(days=r.randint(60, 400)), age, home, payer, "enrollment"))
        if r.random() < 0.2:
            payer = r.choice(payers)[0]
            changes.append((p, start + timedelta(days=r.randint(10, days - 10)), age, home, payer, "payer_change"))
        for code in r.sample([s[0] for s in SERVICES], 2):
            for k in range(2):
                a = start + timedelta(days=k * days // 2)
                auths.append((f"AUTH-{len(auths):06d}", p, payer, code, float(r.randint(40, 200)), a, a + timedelta(days=days // 2 - 1), a - timedelta(days=10)))
            for _ in range(r.randint(8, 25)):
                day = start + timedelta(days=r.randrange(days))
                late = day >= start + timedelta(days=days // 2)
                uom = "" if late and r.random() < defect_share else ("units" if late else "minutes")
                value = r.choice([2, 4, 6]) if late else r.choice([30, 60, 90])
                sessions.append((p, r.choice(providers)[0], code if r.random() > 0.004 else "00000", day, home, value, uom, r.choices(["completed", "cancelled", "no_show"], [0.9, 0.06, 0.04])[0], "ehr"))
    sessions += r.sample(sessions, max(1, len(sessions) // 200))
    sessions.sort(key=lambda s: (s[3], s[0]))
    rows_to(out / "reference_centers.csv", ["center_id", "center_name", "state"], centers)
    rows_to(out / "reference_payers.csv", ["payer_id", "payer_name", "contract_type"], payers)
    rows_to(out / "reference_providers.csv", ["provider_id", "role", "discipline", "center_id", "hire_date", "term_date"], providers)
    rows_to(out / "salesforce_clients.csv", ["client_id", "effective_date", "age_years", "home_center_id", "payer_id", "change_reason"], changes)
    rows_to(out / "payer_authorizations.csv", ["auth_id", "client_id", "payer_id", "service_code", "units_authorized", "period_start", "period_end", "issued_date"], auths)
    rows_to(out / "ehr_sessions.csv", ["session_id", "client_id", "provider_id", "service_code", "service_date", "center_id", "duration_value", "duration_uom", "status", "source_system"], [(f"SES-{i:07d}", *s) for i, s in enumerate(sessions)])
    return out
