"""The privacy boundary: column classes, pseudonyms, content scans and small-cell suppression."""

from __future__ import annotations

import hmac
import os
import re
import secrets

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from unitflow.functions.exprs import masked, pseudonym

#: Shapes of identifiers. Java's word class is ASCII unless (?U) is given.
PATTERNS = {
    "ssn": r"(?U)\b\d{3}-\d{2}-\d{4}\b",
    "email": r"(?U)\b[\w.+-]+@[\w-]+\.[\w.]{2,}\b",
    "phone_us": r"(?<![\d.])(?:\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|(?:1[ .-])?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)",
    "date_of_birth": r"(?U)\b(?:0?[1-9]|1[0-2])[/-](?:0?[1-9]|[12]\d|3[01])[/-](?:19|20)\d{2}\b",
    "mrn_like": r"(?iU)\b(?:MRN|MR#|MEDREC|MEDICAL\s+RECORD)(?:\s*(?:ID|NO|NUM|NUMBER|#))?[ .:#-]*\w{4,}\b",
    "member_id_like": r"(?iU)\b(?:MEMBER|SUBSCRIBER|POLICY)(?:\s*(?:ID|NO|NUM|NUMBER|#))?[ .:#-]*(?=[A-Z0-9-]{6,})[A-Z0-9-]*\d[A-Z0-9-]*\b",
    "us_zip_plus4": r"(?U)\b\d{5}-\d{4}\b",
}
PSEUDONYM = r"^[A-Z]{3}-[0-9A-F]{12}$"
PREFIXES = {"client_id": "CLI", "provider_id": "PRV", "session_id": "SES", "auth_id": "ATH", "client_key": "CLK"}
DIRECT, QUASI, CLINICAL, OPERATIONAL, SAFE = "direct_identifier", "quasi_identifier", "clinical", "operational", "safe"
#: Shapes of source identifiers, in whatever text.
SOURCE_IDS = {"raw_client_id": r"\bCLI-\d{4,6}\b", "raw_provider_id": r"\bPRV-\d{3,5}\b", "raw_session_id": r"\bSES-\d{6,8}\b", "raw_auth_id": r"\bAUTH-\d{5,7}\b"}
#: Columns by class, in any table that declares them; then the columns that each published table has.
_KINDS = dict.fromkeys(PREFIXES, DIRECT) | dict.fromkeys(("age_band", "age_years", "home_center_id", "center_id", "payer_id", "effective_date"), QUASI)
_KINDS |= dict.fromkeys(("service_code", "service_key", "units_authorized", "units_delivered", "minutes_delivered", "minutes", "units", "duration_value", "duration_uom", "utilization", "units_unused", "expected_units", "pace", "performance", "hours_unused", "hours_authorized"), CLINICAL)
_KINDS |= dict.fromkeys(("period_start", "period_end", "issued_date", "service_date", "status", "uom_resolved", "unresolved_reason", "version", "valid_from", "valid_to", "is_current", "change_reason", "hire_date", "term_date", "is_active", "days_to_expiry", "is_closed", "elapsed_days", "elapsed_fraction", "authorized_days", "is_completed", "is_cancelled", "is_no_show", "source_system", "sessions"), OPERATIONAL)
_KINDS |= dict.fromkeys(("provider_key", "center_key", "payer_key", "date_key", "period_start_key", "period_end_key"), OPERATIONAL)
_KINDS |= dict.fromkeys(("service_name", "discipline", "minutes_per_unit", "role", "center_name", "state", "payer_name", "contract_type", "full_date", "year", "quarter", "month", "month_name", "year_month", "day_of_week", "day_name", "is_weekend", "coverage"), SAFE)
_COLUMNS = {
    "dim_client": "client_key client_id version valid_from valid_to is_current age_years age_band home_center_id payer_id change_reason",
    "dim_service": "service_key service_code service_name discipline minutes_per_unit",
    "dim_provider": "provider_key provider_id role discipline center_id hire_date term_date is_active",
    "dim_center": "center_key center_id center_name state",
    "dim_payer": "payer_key payer_id payer_name contract_type",
    "dim_date": "date_key full_date year quarter month month_name year_month day_of_week day_name is_weekend",
    "fact_session": "session_id date_key client_key client_id provider_key provider_id service_key service_code center_key center_id service_date version duration_value duration_uom status units minutes units_delivered minutes_delivered uom_resolved unresolved_reason is_completed is_cancelled is_no_show source_system",
    "fact_authorization": "auth_id client_key client_id service_key service_code payer_key payer_id period_start period_end period_start_key period_end_key issued_date version units_authorized authorized_days",
    "utilization": "auth_id client_key client_id service_key service_code payer_key payer_id period_start period_end period_start_key period_end_key issued_date version units_authorized units_delivered minutes_delivered sessions utilization units_unused hours_authorized hours_unused days_to_expiry is_active is_closed authorized_days elapsed_days elapsed_fraction expected_units pace performance payer_name contract_type home_center_id center_name",
}
#: The class of each column of each published table. A column that is not here is a direct identifier.
CLASSES = {t: {c: _KINDS[c] for c in own.split()} for t, own in _COLUMNS.items()}
THRESHOLD, MARK = 10, "<11"
_process_salt = secrets.token_bytes(32)
DEV_SALT = b"development-only"


def classify(table: str, column: str) -> str:
    return CLASSES.get(table, {}).get(column, DIRECT)


def undeclared(df: DataFrame, table: str) -> list[str]:
    return [c for c in df.columns if c not in CLASSES.get(table, {})]


def redact_records(records: list[dict]) -> list[dict]:
    """Sample rows as they may be shown: identifier columns as pseudonyms of this process, source identifiers elsewhere struck out."""
    def shown(name: str, value):
        if value is None or value == "":
            return value
        if name in PREFIXES:
            return f"{PREFIXES[name]}-{hmac.new(salt()[0], str(value).encode(), 'sha256').hexdigest()[:12].upper()}"
        clean = str(value)
        for shape in SOURCE_IDS.values():
            clean = re.sub(shape, "[redacted]", clean)
        return value if clean == str(value) else clean

    return [{k: shown(k, v) for k, v in r.items()} for r in records]


def redacted(c: Column) -> Column:
    """A text column with source identifiers struck out."""
    for shape in SOURCE_IDS.values():
        c = F.regexp_replace(c, f"(?U){shape}", "[redacted]")
    return c


def source_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """pattern, matches: raw source identifiers in a column of text, counted by the executors."""
    c = F.coalesce(F.col(column), F.lit(""))
    one = lines.agg(*[F.coalesce(F.sum(F.regexp_count(c, F.lit(f"(?U){shape}"))), F.lit(0)).alias(name) for name, shape in SOURCE_IDS.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("pattern"), F.col(n).cast("long").alias("matches")) for n in SOURCE_IDS])).alias("x")).select("x.*").where("matches > 0")


def published_findings(spark: SparkSession, paths: list[str]) -> list[tuple[str, str, int]]:
    """(path, pattern, matches) of raw identifiers in what was written, read back as text."""
    return [(p, r.pattern, r.matches) for p in paths for r in source_ids(spark.read.text(p, recursiveFileLookup=True)).collect()]


def salt(variable: str = "UNITFLOW_SALT") -> tuple[bytes, str]:
    """(salt, state): configured, development or ephemeral (new in each process, so nothing joins across runs)."""
    own = os.environ.get(variable, "").encode()
    return (_process_salt, "ephemeral") if not own else (own, "development" if own == DEV_SALT else "configured")


def deidentified(df: DataFrame, key: bytes, table: str) -> DataFrame:
    """Declared identifiers as pseudonyms, undeclared columns left out."""
    return df.select(*[pseudonym(F.col(c), key, PREFIXES[c]).alias(c) if classify(table, c) == DIRECT else F.col(c) for c in df.columns if c in CLASSES.get(table, {})])


def scan(df: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """column, pattern, matches, example (masked): one aggregate over all rows and string columns."""
    patterns = PATTERNS if patterns is None else patterns
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    pairs = [(c, p) for c in cols for p in patterns]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, pattern string, matches long, example string")
    # one extraction a row, column and pattern: null where there is no match
    found = lambda c, p: F.regexp_substr(F.col(f"`{c}`"), F.lit(patterns[p]))
    one = df.agg(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("pattern"), F.count(found(c, p)).alias("matches"), masked(F.min(found(c, p))).alias("example")).alias(f"s{i}") for i, (c, p) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(pairs))])).alias("s")).select("s.*").where("matches > 0")


def is_pseudonymised(df: DataFrame, column: str) -> bool:
    c = F.col(column)
    return df.where(c.isNotNull() & (c != "") & ~c.rlike(PSEUDONYM)).limit(1).count() == 0


def egress_findings(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    """(table, column, reason) of what must not leave: undeclared columns, raw identifiers, identifier-shaped contents."""
    own = CLASSES.get(table, {})
    out = [(table, c, "undeclared") for c in undeclared(df, table)]
    out += [(table, c, "unpseudonymised_identifier") for c in df.columns if own.get(c) == DIRECT and not is_pseudonymised(df, c)]
    rest = df.select(*[c for c in df.columns if c in own and own[c] != DIRECT])
    return out + [(table, r["column"], f"content_match:{r.pattern}") for r in scan(rest).collect()]


def small(n: Column) -> Column:
    """A count that must not be shown: from 1 to the threshold. Null and zero may."""
    return F.coalesce((n > 0) & (n <= THRESHOLD), F.lit(False))


def suppress(df: DataFrame, count: str, order: str, group: str | None = None, derived: tuple[str, ...] = (), total_is_published: bool = True) -> DataFrame:
    """Small counts and what derives from them as text marks, and a flag ``suppressed``.

    If just one cell of a published total is small, the least other cell (zero included, ties by ``order``) goes as well, as
    subtraction would tell. With ``group`` each group is a table of its own; rows of a null group go.
    """
    rows = df.where(F.col(group).isNotNull()) if group else df
    by = [F.col(group)] if group else [F.lit(0)]
    n = F.col(count).cast("double")
    rows = rows.withColumn("_primary", small(n))
    hidden = F.count_if("_primary").over(Window.partitionBy(*by))
    victim = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("_primary"), n.asc_nulls_last(), order))
    second = (hidden == 1) & ~F.col("_primary") & (victim == 1) & n.isNotNull() if total_is_published else F.lit(False)
    rows = rows.withColumn("suppressed", F.col("_primary") | second).drop("_primary")
    return rows.withColumns({c: F.when(F.col("suppressed"), F.lit(MARK)).otherwise(F.col(c).cast("string")) for c in (count, *derived)})


def disclosive(df: DataFrame, count: str) -> DataFrame:
    """Rows that still show a small count."""
    return df.where(small(F.col(count).try_cast("double")))
