"""Further registered queries: keys of the facts, the gate's checks, joins by role, digests, redaction, the store. Imported by ``queries``."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitflow.functions import exprs
from unitflow.operators import analytics as an
from unitflow.operators import checks, conform, privacy
from unitflow.plans import publish
from unitflow.plans.store import Store, load_incrementally
from unitflow.queries import AUTHS, CATALOGUE, RESOLVED, RISK, SESSIONS, UTIL, VERSIONS, query, r, resolved, util, versions
from unitflow.sources import adaptors as src


def place(spark: SparkSession) -> str:
    """A new folder that the session's cluster shares; of a local session without one, its own temp folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/unitflow-{uuid.uuid4().hex}"


# --- dates and keys ----------------------------------------------------------------------------------------------------


@query("SELECT MIN(d) AS first_day, MAX(d) AS last_day FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION ALL SELECT CAST(ts AS DATE) FROM events)")
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: src.table(spark, sf_dir, n)
    return conform.date_bounds([(t("orders"), "o_orderdate"), (t("lineitem"), "l_shipdate"), (t("events"), "ts")])


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_date over the days of sessions and both ends of all periods."""
    s, a = src.sessions(spark, sf_dir), src.authorizations(spark, sf_dir)
    days = conform.date_bounds([(s, "service_date"), (a, "period_start"), (a, "period_end")]).first()
    return conform.date_spine(spark, str(days.first_day), str(days.last_day))


@query(f"WITH {AUTHS}, b AS (SELECT LEAST((SELECT MIN(CAST(ts AS DATE)) FROM events), MIN(p_start)) AS a, GREATEST((SELECT MAX(CAST(ts AS DATE)) FROM events), MAX(p_end)) AS z FROM auths) SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, isodow(d) > 5 AS is_weekend FROM generate_series((SELECT a FROM b), (SELECT z FROM b), INTERVAL 1 DAY) AS t(d)")
def dim_date_of_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spine(spark, sf_dir).select("date_key", "full_date", "is_weekend")


def providers(spark: SparkSession) -> DataFrame:
    """Members of five providers are missing on purpose."""
    return conform.surrogate_keys(spark.range(80).select(F.col("id").alias("provider_id")), ["provider_id"], "provider_key")


def centers(spark: SparkSession) -> DataFrame:
    return conform.surrogate_keys(spark.range(4).select(F.col("id").alias("center_id"), F.concat(F.lit("Centre "), F.col("id").cast("string")).alias("center_name")), ["center_id"], "center_key")


def payers(spark: SparkSession) -> DataFrame:
    """Payer 1 is listed with two contracts."""
    rows = spark.range(3).select(F.col("id").alias("payer_id"), F.concat(F.lit("Payer "), F.col("id").cast("string")).alias("payer_name"), F.when(F.col("id") % 2 == 1, "value_based").otherwise("fee_for_service").alias("contract_type"))
    return rows.unionByName(rows.where("payer_id = 1").withColumn("contract_type", F.lit("capitated")))


def services(spark: SparkSession) -> DataFrame:
    return conform.surrogate_keys(src.catalogue(spark, without=("error",)).select("service_code"), ["service_code"], "service_key")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every third client, one of the others."""
    people = src.sessions(spark, sf_dir).select("client_id").distinct()
    moves = people.select("client_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("i")).where("i = 0 OR client_id % 3 = 0")
    moves = moves.select("client_id", F.date_add(F.lit("2024-01-05").cast("date"), F.col("i") * 15).alias("effective_date"), ((F.col("client_id") + F.col("i")) % 4).alias("payer_id"), ((F.col("client_id") + 2 * F.col("i")) % 5).alias("home_center_id"))
    v = conform.scd2(moves, "client_id", "effective_date", ["payer_id"])
    return v.withColumn("client_key", F.concat_ws("-", F.col("client_id").cast("string"), F.col("version").cast("string")))


CLIENTS = """clients AS (SELECT u AS client_id, 1 AS version, DATE '2024-01-05' AS valid_from, CASE WHEN u % 3 = 0 THEN DATE '2024-01-19' ELSE DATE '9999-12-31' END AS valid_to, u % 4 AS payer_id, u % 5 AS home, u % 3 <> 0 AS is_current FROM (SELECT DISTINCT user_id AS u FROM events)
  UNION ALL SELECT u, 2, DATE '2024-01-20', DATE '9999-12-31', (u + 1) % 4, (u + 2) % 5, TRUE FROM (SELECT DISTINCT user_id AS u FROM events WHERE user_id % 3 = 0))"""
SERVICE_KEY = "CASE service_code WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 0 END"
FACTS = f"facts AS (SELECT s.*, c.version, CAST(s.client_id AS VARCHAR) || '-' || CAST(c.version AS VARCHAR) AS client_key, {SERVICE_KEY} AS service_key, CASE WHEN s.provider_id < 80 THEN CAST(s.provider_id + 1 AS INTEGER) END AS provider_key, CASE WHEN s.center_id < 4 THEN CAST(s.center_id + 1 AS INTEGER) END AS center_key FROM resolved s JOIN clients c ON c.client_id = s.client_id AND s.service_date BETWEEN c.valid_from AND c.valid_to)"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.fact_session(resolved(spark, sf_dir), clients(spark, sf_dir), services(spark), providers(spark), centers(spark))


@query(f"WITH {RESOLVED}, {CLIENTS}, {FACTS} SELECT session_id, client_key, CAST(strftime(service_date, '%Y%m%d') AS INTEGER) AS date_key, service_key, provider_key, center_key, status = 'cancelled' AS is_cancelled, ROUND(CASE WHEN status = 'completed' THEN units ELSE 0 END, 6) AS units_delivered FROM facts")
def fact_session_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select("session_id", "client_key", "date_key", "service_key", "provider_key", "center_key", "is_cancelled", r("units_delivered").alias("units_delivered"))


def authorizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.authorizations(spark, sf_dir).withColumn("payer_id", F.col("client_id") % 4)


@query(f"""WITH {AUTHS}, {CLIENTS}, j AS (SELECT a.*, c.version, ROW_NUMBER() OVER (PARTITION BY auth_id ORDER BY p_start BETWEEN valid_from AND valid_to DESC, valid_from) AS rn FROM auths a JOIN clients c USING (client_id))
  SELECT auth_id, CAST(client_id AS VARCHAR) || '-' || CAST(version AS VARCHAR) AS client_key, {SERVICE_KEY} AS service_key, CASE WHEN client_id % 4 < 3 THEN CAST(client_id % 4 + 1 AS INTEGER) END AS payer_key, CAST(strftime(p_start, '%Y%m%d') AS INTEGER) AS period_start_key, CAST(strftime(p_end, '%Y%m%d') AS INTEGER) AS period_end_key, CAST(p_end - p_start + 1 AS INTEGER) AS authorized_days FROM j WHERE rn = 1""")
def fact_authorization_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = conform.surrogate_keys(payers(spark).select("payer_id").distinct(), ["payer_id"], "payer_key")
    f = conform.fact_authorization(authorizations(spark, sf_dir), clients(spark, sf_dir), services(spark), known)
    return f.select("auth_id", "client_key", "service_key", "payer_key", "period_start_key", "period_end_key", "authorized_days")


# --- joins by role and history -----------------------------------------------------------------------------------------


@query(f"""WITH {UTIL}, {CLIENTS} SELECT auth_id, CASE WHEN u.client_id % 4 < 3 THEN 'Payer ' || CAST(u.client_id % 4 AS VARCHAR) END AS payer_name, CASE u.client_id % 4 WHEN 0 THEN 'fee_for_service' WHEN 1 THEN 'capitated' WHEN 2 THEN 'fee_for_service' END AS contract_type, home AS home_center_id, CASE WHEN home < 4 THEN 'Centre ' || CAST(home AS VARCHAR) END AS center_name FROM util u JOIN clients c ON c.client_id = u.client_id AND c.is_current""")
def utilization_with_payer_and_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = util(spark, sf_dir).withColumn("payer_id", F.col("client_id") % 4)
    return an.with_payer_and_home(u, payers(spark), clients(spark, sf_dir), centers(spark)).select("auth_id", "payer_name", "contract_type", "home_center_id", "center_name")


@query(f"WITH {AUTHS} SELECT auth_id, strftime(p_start, '%Y-%m') AS start_month, strftime(p_end, '%Y-%m') AS end_month FROM auths")
def authorization_role_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.role_months(src.authorizations(spark, sf_dir), spine(spark, sf_dir))


@query(f"WITH {VERSIONS}, p AS (SELECT payer_id AS payer_before, LEAD(payer_id) OVER (PARTITION BY client_id ORDER BY version) AS payer_after FROM v) SELECT payer_before, payer_after, COUNT(*) AS n FROM p WHERE payer_after IS NOT NULL GROUP BY ALL")
def sibling_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.sibling_versions(versions(spark, sf_dir)).groupBy("payer_before", "payer_after").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 0)")
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = src.table(spark, sf_dir, "supplier").where("s_suppkey % 10 <> 0").withColumnRenamed("s_suppkey", "l_suppkey")
    return checks.orphans(src.table(spark, sf_dir, "lineitem"), members, "l_suppkey").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


# --- checks of the gate ------------------------------------------------------------------------------------------------


@query(f"WITH {RESOLVED}, {CLIENTS}, {FACTS} SELECT COUNT(*) AS facts, COUNT(*) FILTER (WHERE provider_key IS NULL OR center_key IS NULL) AS orphans FROM facts")
def orphan_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = facts(spark, sf_dir)
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    return n(f, "facts").crossJoin(F.broadcast(n(checks.without_member(f, ["date_key", "client_key", "provider_key", "center_key"]), "orphans")))  # one row each


@query(f"WITH {RESOLVED}, {AUTHS} SELECT COUNT(*) AS sessions, ROUND(COALESCE(SUM(units), 0), 6) AS units FROM resolved s WHERE status = 'completed' AND ok AND NOT EXISTS (SELECT 1 FROM auths a WHERE a.client_id = s.client_id AND a.service_code = s.service_code AND a.center_id IS NOT NULL AND s.service_date BETWEEN a.p_start AND a.p_end)")
def sessions_without_authorization(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = checks.exposure(an.unmatched(resolved(spark, sf_dir), src.authorizations(spark, sf_dir).where("center_id IS NOT NULL")))
    return e.select("sessions", r("units").alias("units"))


@query("WITH m AS (SELECT strftime(l_shipdate, '%Y-%m') AS year_month, MEDIAN(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1), s AS (SELECT year_month, COALESCE(ABS(q / LAG(q) OVER (ORDER BY year_month) - 1), 0) AS shift FROM m) SELECT year_month AS worst_month, ROUND(shift, 6) AS shift FROM s ORDER BY s.shift DESC, year_month DESC LIMIT 1")
def session_length_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = src.table(spark, sf_dir, "lineitem")
    s = li.select(F.when(F.col("l_returnflag") == "R", "cancelled").otherwise("completed").alias("status"), F.lit(True).alias("uom_resolved"), F.to_date("l_shipdate").alias("service_date"), F.col("l_quantity").alias("minutes"))
    return checks.length_shift(s).select("worst_month", r("shift").alias("shift"))


@query(f"WITH {RESOLVED}, {AUTHS}, {CLIENTS}, {FACTS} SELECT (SELECT COUNT(*) FROM facts) AS sessions, (SELECT COUNT(*) FROM auths) AS authorizations, (SELECT COUNT(DISTINCT client_id) FROM clients) AS clients, (SELECT COUNT(*) FROM clients) AS client_versions")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_counts(facts(spark, sf_dir), src.authorizations(spark, sf_dir), clients(spark, sf_dir))


@query(f"""WITH {UTIL}, x AS (SELECT (SELECT AVG(CAST(ok AS INTEGER)) FROM resolved) < 0.99 AS cover, (SELECT COUNT(*) FROM resolved WHERE status = 'completed' AND ok AND (minutes < 5 OR minutes > 480)) > 0 AS odd)
  SELECT 'duration_plausibility' AS name, CASE WHEN odd THEN 'refused' ELSE 'passed' END AS decision FROM x UNION ALL SELECT 'uom_resolution_coverage', CASE WHEN cover THEN 'acknowledged' ELSE 'passed' END FROM x""")
def gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocking checks against acknowledgements: one with a reason, one with too short a reason."""
    done = checks.collected(checks.core_checks(resolved(spark, sf_dir), util(spark, sf_dir), src.catalogue(spark, without=("error",))))
    d = checks.gate(done, {"uom_resolution_coverage": "the vendor dropped the unit field", "duration_plausibility": "short"})
    rows = [(c.name, "passed" if c.passed else "acknowledged" if c.name in d.acknowledged else "refused") for c in done if c.severity == checks.BLOCK]
    return spark.createDataFrame(rows, "name string, decision string")


@query(f"WITH {RESOLVED} SELECT session_id, CAST(minutes AS DOUBLE) AS minutes FROM resolved WHERE status = 'completed' AND ok AND (minutes < 5 OR minutes > 480) ORDER BY session_id LIMIT 5")
def samples_of_a_finding(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = resolved(spark, sf_dir).where("status = 'completed' AND uom_resolved AND NOT minutes BETWEEN 5 AND 480")
    return bad.select("session_id", "minutes").orderBy("session_id").limit(checks.SAMPLE)


# --- what is published -------------------------------------------------------------------------------------------------

PLAN = f"""risk AS (SELECT * FROM util WHERE {RISK}), n AS (SELECT center_id, COUNT(DISTINCT client_id) AS n FROM risk GROUP BY 1), p AS (SELECT *, n <= 10 AS small FROM n),
  q AS (SELECT *, COUNT(*) FILTER (WHERE small) OVER () AS hidden, ROW_NUMBER() OVER (ORDER BY small, n, center_id NULLS FIRST) AS rn FROM p), plan AS (SELECT center_id, n, small OR (hidden = 1 AND rn = 1) AS suppressed FROM q)"""


@query(f"WITH {UTIL}, {PLAN} SELECT center_id, CASE WHEN suppressed THEN '<11' ELSE CAST(n AS VARCHAR) END AS clients, suppressed FROM plan")
def centre_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.plan_centres(an.at_risk(util(spark, sf_dir))).select("center_id", "clients", "suppressed")


@query(f"""WITH {UTIL}, {PLAN}, s AS (SELECT r.*, plan.center_id AS section FROM risk r LEFT JOIN plan ON plan.center_id = r.center_id AND NOT suppressed),
  k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY section ORDER BY days_to_expiry, hours_unused DESC, auth_id) AS rank, COUNT(*) OVER (PARTITION BY section) AS n_rows FROM s)
  SELECT section, CAST(rank AS INTEGER) AS rank, auth_id, CAST(GREATEST(n_rows - 12, 0) AS BIGINT) AS more FROM k WHERE rank <= 12""")
def digest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.digest_rows(an.at_risk(util(spark, sf_dir))).select("section", "rank", "auth_id", "more")


NOTE = "'client CLI-' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') || ' and AUTH-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') || ' or CLI-123'"


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = src.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.concat(F.lit("client CLI-"), F.lpad(F.col("o_custkey").cast("string"), 5, "0"), F.lit(" and AUTH-"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"), F.lit(" or CLI-123")).alias("note"))


@query(f"SELECT o_orderkey, regexp_replace(regexp_replace({NOTE}, '\\bCLI-\\d{{4,6}}\\b', '[redacted]', 'g'), '\\bAUTH-\\d{{5,7}}\\b', '[redacted]', 'g') AS note FROM orders")
def redacted_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes(spark, sf_dir).select("o_orderkey", privacy.redacted(F.col("note")).alias("note"))


@query("SELECT 'raw_client_id' AS pattern, COUNT(*) AS matches FROM orders UNION ALL SELECT 'raw_auth_id', COUNT(*) FROM orders")
def source_ids_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.source_ids(notes(spark, sf_dir), "note")


@query("SELECT c_custkey, CASE WHEN c_custkey % 16 <= 3 THEN '0-3' WHEN c_custkey % 16 <= 5 THEN '4-5' WHEN c_custkey % 16 <= 8 THEN '6-8' WHEN c_custkey % 16 <= 12 THEN '9-12' ELSE '13+' END AS age_band, substr(c_name, 1, 2) || '…' || right(c_name, 2) AS masked, COALESCE(NULLIF(c_custkey % 3, 2) = 1, FALSE) AS flagged, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS finite_balance, CAST(c_custkey % 30 + 1 AS INTEGER) AS days FROM customer")
def column_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    start = F.lit("2024-01-01").cast("date")
    return src.table(spark, sf_dir, "customer").select(
        "c_custkey", exprs.age_band(k % 16).alias("age_band"), exprs.masked(F.col("c_name")).alias("masked"), exprs.flag(F.when(k % 3 != 2, k % 3)).alias("flagged"),
        exprs.finite(F.when(k % 7 == 0, F.lit(float("inf"))).otherwise(F.col("c_acctbal"))).alias("finite_balance"), exprs.days_between(F.date_add(start, (k % 30).cast("int")), start).alias("days"),
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_orderkey % 2 AS INTEGER) AS is_odd, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders")
def csv_export_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported with booleans as numbers, dates as text and nulls as empty fields, and scanned with a declared schema."""
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), (F.col("o_orderkey") % 2 == 1).alias("is_odd"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    path = place(spark)
    publish.export_csv(o, path)
    return spark.read.schema("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, is_odd int, o_orderpriority string").option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


# --- the store ---------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0")
def store_keeps_the_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build that is refused does not replace the one that was accepted."""
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    s = Store(place(spark), spark)
    s.build("r1", {"orders": o.where("o_orderkey % 2 = 0"), "other": o.limit(1)})
    s.build("r2", {"orders": o}, lambda t: t["orders"].where("o_orderkey % 2 = 1").limit(1).count() == 0)
    return s.read(spark, "orders")


@query("SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-18' THEN value + 1 ELSE value END AS value, '2024-01-30' AS mark FROM events WHERE (SELECT MAX(CAST(ts AS DATE)) FROM events) = DATE '2024-01-30'")
def incremental_load_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mark, lookback, merge, pointer, mark: a first load to 25 January, then everything, corrected within the lookback; another table stays."""
    e = src.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "value")
    s = Store(place(spark), spark)
    s.build("r0", {"other": e.limit(1)})
    load_incrementally(s, spark, "ehr", "events", e.where(F.col("day") <= F.lit(date(2024, 1, 25))), "day", ["event_id"], 7, "r1")
    done = load_incrementally(s, spark, "ehr", "events", e.withColumn("value", F.col("value") + 1), "day", ["event_id"], 7, "r2")
    assert s.read(spark, "other").count() == 1
    return s.read(spark, "events").select("event_id", "value", F.lit(done["mark"]).alias("mark"))


@query(f"WITH {SESSIONS}, k AS (SELECT service_code FROM {CATALOGUE}) SELECT service_code, CAST(ROW_NUMBER() OVER (PARTITION BY service_code ORDER BY service_date, session_id) AS INTEGER) AS rank, session_id, CAST(GREATEST(COUNT(*) OVER (PARTITION BY service_code) - 3, 0) AS BIGINT) AS more FROM sessions JOIN k USING (service_code) QUALIFY rank <= 3")
def first_rows_of_a_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.first_rows(src.sessions(spark, sf_dir), "service_code", [F.col("service_date"), F.col("session_id")], 3).select("service_code", "rank", "session_id", "more")
