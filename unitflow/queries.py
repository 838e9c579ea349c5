"""The registered queries over the test tables, each with the DuckDB SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unitflow.functions.exprs import pseudonym, ratio
from unitflow.operators import analytics as an
from unitflow.operators import changes as ch
from unitflow.operators import checks, conform, privacy
from unitflow.plans import corpus, metrics
from unitflow.sources import adaptors as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
KEY = b"a fixed key of the tests"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r(c: str | Column, n: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), n)


# --- the oracle's views ------------------------------------------------------------------------------------------------

CATALOGUE = "(VALUES " + ", ".join(f"('{c}', '{n}', '{d}', {m})" for c, n, d, m in src.CATALOGUE) + ") AS catalogue(service_code, service_name, discipline, mpu)"
SESSIONS = """sessions AS (
  SELECT event_id AS session_id, user_id AS client_id, event_type AS service_code, CAST(ts AS DATE) AS service_date,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS amount,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'hours' WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN 'minutes' ELSE 'units' END AS uom,
    CASE WHEN event_id % 25 = 0 THEN 'no_show' WHEN event_id % 25 IN (1, 2) THEN 'cancelled' ELSE 'completed' END AS status,
    user_id % 5 AS center_id, event_id % 85 AS provider_id
  FROM events)"""
RESOLVED = f"""{SESSIONS}, cat AS (SELECT * FROM {CATALOGUE} WHERE service_code <> 'error'),
judged AS (
  SELECT s.*, mpu, CASE WHEN amount IS NULL THEN 'non_numeric_duration' WHEN mpu IS NULL THEN 'unmapped_service_code' WHEN uom IS NULL THEN 'missing_uom'
    WHEN uom NOT IN ('minutes', 'units') THEN 'unrecognised_uom' END AS reason
  FROM sessions s LEFT JOIN cat USING (service_code)),
resolved AS (
  SELECT *, reason IS NULL AS ok, CASE WHEN reason IS NOT NULL THEN 0 WHEN uom = 'minutes' THEN amount ELSE amount * mpu END AS minutes,
    CASE WHEN reason IS NOT NULL THEN 0 WHEN uom = 'minutes' THEN amount / mpu ELSE amount END AS units FROM judged)"""
AUTHS = """auths AS (
  SELECT CAST(client_id AS VARCHAR) || '-' || service_code || '-' || CAST(k AS VARCHAR) AS auth_id, client_id, service_code, CAST(4 + client_id % 5 AS DOUBLE) AS authorized,
    DATE '2024-01-01' + CAST(13 * k AS INTEGER) AS p_start, DATE '2024-01-13' + CAST(13 * k AS INTEGER) AS p_end, CASE WHEN client_id % 7 <> 0 THEN client_id % 5 END AS center_id
  FROM (SELECT DISTINCT user_id AS client_id, event_type AS service_code FROM events), (VALUES (0), (1), (2)) AS t(k))"""
UTIL = f"""{RESOLVED}, {AUTHS},
rolled AS (
  SELECT a.*, COALESCE(SUM(s.units), 0) AS delivered, COALESCE(SUM(s.minutes), 0) AS minutes, COUNT(s.session_id) AS n
  FROM auths a LEFT JOIN (SELECT * FROM resolved WHERE status = 'completed' AND ok) s
    ON s.client_id = a.client_id AND s.service_code = a.service_code AND s.service_date BETWEEN a.p_start AND a.p_end
  GROUP BY ALL),
util AS (
  SELECT r.*, COALESCE(mpu, 0) AS mpu, delivered / NULLIF(authorized, 0) AS utilization, GREATEST(authorized - delivered, 0) AS unused, authorized * COALESCE(mpu, 0) / 60 AS hours_authorized,
    GREATEST(authorized - delivered, 0) * COALESCE(mpu, 0) / 60 AS hours_unused, date_diff('day', DATE '2024-01-30', p_end) AS days_to_expiry,
    p_start <= DATE '2024-01-30' AND DATE '2024-01-30' <= p_end AS active, p_end < DATE '2024-01-30' AS closed,
    authorized * LEAST(GREATEST(date_diff('day', p_start, LEAST(p_end, DATE '2024-01-30')) + 1, 0) / (date_diff('day', p_start, p_end) + 1.0), 1.0) AS expected
  FROM rolled r LEFT JOIN cat USING (service_code))"""


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.resolve_units(src.sessions(spark, sf_dir), src.catalogue(spark, without=("error",)))


def util(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.utilization(src.authorizations(spark, sf_dir), resolved(spark, sf_dir), src.catalogue(spark, without=("error",)), F.lit(src.AS_OF).cast("date"))


# --- roll-up and analytics ---------------------------------------------------------------------------------------------


@query(f"WITH {UTIL} SELECT auth_id, authorized AS units_authorized, ROUND(delivered, 6) AS units_delivered, CAST(n AS BIGINT) AS sessions, ROUND(utilization, 6) AS utilization, ROUND(expected, 6) AS expected_units, ROUND(delivered / NULLIF(expected, 0), 9) AS pace, closed AS is_closed FROM util")
def rollup_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return util(spark, sf_dir).select("auth_id", "units_authorized", r("units_delivered").alias("units_delivered"), F.col("sessions").cast("long"), r("utilization").alias("utilization"), r("expected_units").alias("expected_units"), r("pace", 9).alias("pace"), "is_closed")


BY = "COUNT(*) AS authorizations, COUNT(DISTINCT client_id) AS clients, ROUND(SUM(delivered), 6) AS units_delivered, ROUND(SUM(delivered) / NULLIF(SUM(authorized), 0), 6) AS utilization, ROUND(SUM(delivered) / NULLIF(SUM(expected), 0), 6) AS pace, ROUND(SUM(hours_unused), 6) AS hours_unused FROM util GROUP BY 1"


def by(spark: SparkSession, sf_dir: str, c: str) -> DataFrame:
    return an.by_dimension(util(spark, sf_dir), c).select(c, "authorizations", "clients", r("units_delivered", 6).alias("units_delivered"), r("utilization").alias("utilization"), r("pace").alias("pace"), r("hours_unused", 6).alias("hours_unused"))


@query(f"WITH {UTIL} SELECT service_code, {BY}")
def utilization_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by(spark, sf_dir, "service_code")


@query(f"WITH {UTIL} SELECT center_id, {BY}")
def utilization_by_group_null_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by(spark, sf_dir, "center_id")


@query(f"WITH {UTIL} SELECT closed AS is_closed, COUNT(*) AS authorizations, ROUND(SUM(CASE WHEN closed THEN delivered / NULLIF(authorized, 0) ELSE delivered / NULLIF(expected, 0) END), 6) AS performance FROM util GROUP BY closed")
def pace_open_vs_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return util(spark, sf_dir).groupBy("is_closed").agg(F.count(F.lit(1)).alias("authorizations"), r(F.sum("performance"), 6).alias("performance"))


RISK = "active AND days_to_expiry BETWEEN 0 AND 30 AND authorized > 0 AND unused / authorized >= 0.25"


@query(f"WITH {UTIL} SELECT auth_id, CAST(days_to_expiry AS INTEGER) AS days_to_expiry, ROUND(hours_unused, 6) AS hours_unused FROM util WHERE {RISK}")
def at_risk_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.at_risk(util(spark, sf_dir)).select("auth_id", "days_to_expiry", r("hours_unused").alias("hours_unused"))


@query(f"""WITH {UTIL} SELECT COUNT(*) FILTER (WHERE NOT closed) AS open_auths, COUNT(*) FILTER (WHERE closed) AS closed_auths, ROUND(SUM(hours_unused) FILTER (WHERE NOT closed), 6) AS hours_unused_open,
  ROUND(SUM(delivered) FILTER (WHERE NOT closed) / SUM(expected) FILTER (WHERE NOT closed), 6) AS pace_open, ROUND(SUM(delivered) FILTER (WHERE closed) / SUM(authorized) FILTER (WHERE closed), 6) AS utilization_closed,
  COUNT(*) FILTER (WHERE {RISK}) AS at_risk, ROUND(SUM(hours_unused) FILTER (WHERE {RISK}), 6) AS hours_at_risk, COUNT(DISTINCT client_id) FILTER (WHERE {RISK}) AS clients_at_risk FROM util""")
def headline_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = an.headline(util(spark, sf_dir))
    return h.select("open_auths", "closed_auths", r("hours_unused_open", 6).alias("hours_unused_open"), r("pace_open").alias("pace_open"), r("utilization_closed").alias("utilization_closed"), "at_risk", r("hours_at_risk", 6).alias("hours_at_risk"), "clients_at_risk")


@query(f"WITH {RESOLVED}, {AUTHS} SELECT s.session_id, s.client_id, s.service_code, s.service_date FROM resolved s WHERE status = 'completed' AND ok AND NOT EXISTS (SELECT 1 FROM auths a WHERE a.client_id = s.client_id AND a.service_code = s.service_code AND a.center_id IS NOT NULL AND s.service_date BETWEEN a.p_start AND a.p_end)")
def unmatched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.unmatched(resolved(spark, sf_dir), src.authorizations(spark, sf_dir).where("center_id IS NOT NULL")).select("session_id", "client_id", "service_code", "service_date")


@query(f"WITH {RESOLVED} SELECT strftime(service_date, '%Y-%m') AS year_month, COUNT(DISTINCT client_id) AS clients, COUNT(*) AS sessions, ROUND(SUM(minutes) / 60, 6) AS hours, COUNT(*) FILTER (WHERE ok) AS resolved, ROUND(AVG(CAST(ok AS INTEGER)), 6) AS coverage, ROUND(MEDIAN(minutes) FILTER (WHERE ok), 6) AS median_minutes FROM resolved WHERE status = 'completed' GROUP BY 1")
def monthly_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.monthly_delivery(resolved(spark, sf_dir)).select("year_month", "clients", "sessions", r("hours", 6).alias("hours"), "resolved", r("coverage").alias("coverage"), r("median_minutes").alias("median_minutes"))


@query(f"WITH {RESOLVED} SELECT strftime(service_date, '%Y-%m') AS year_month, ROUND(AVG(CAST(ok AS INTEGER)), 6) AS coverage FROM resolved WHERE status = 'completed' GROUP BY 1")
def coverage_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.coverage_by_month(resolved(spark, sf_dir)).select("year_month", r("coverage", 6).alias("coverage"))


SHIP_MONTH = "SELECT strftime(l_shipdate, '%Y-%m') AS year_month, AVG(CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE 1.0 END) AS coverage, MEDIAN(l_quantity) AS median_minutes FROM lineitem GROUP BY 1"


def ship_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = src.table(spark, sf_dir, "lineitem")
    return li.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("year_month")).agg(F.avg(F.when(F.col("l_returnflag") == "R", 0.0).otherwise(1.0)).alias("coverage"), F.median("l_quantity").alias("median_minutes"))


@query(f"""WITH m AS ({SHIP_MONTH}), c AS (SELECT *, LAG(coverage) OVER (ORDER BY year_month) - coverage AS fall, LAG(coverage) OVER (ORDER BY year_month) AS before FROM m),
  w AS (SELECT year_month AS worst_month, before, coverage AS after, fall, (before + coverage) / 2 AS half FROM c WHERE fall IS NOT NULL ORDER BY fall DESC, year_month LIMIT 1)
  SELECT worst_month, ROUND(before, 6) AS before, ROUND(after, 6) AS after, ROUND(fall, 6) AS "drop", fall > 0.02 AS exceeds, (SELECT BOOL_AND(coverage < half) FROM m WHERE year_month >= worst_month) AS persisted, (SELECT BOOL_AND(coverage > half) FROM m WHERE year_month < worst_month) AS clean_before FROM w""")
def coverage_step_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = an.worst_drop(ship_months(spark, sf_dir))
    return w.select("worst_month", r("before", 6).alias("before"), r("after", 6).alias("after"), r("drop", 6).alias("drop"), "exceeds", "persisted", "clean_before")


@query(f"WITH m AS ({SHIP_MONTH}) SELECT year_month, median_minutes, ROUND(ABS(median_minutes / LAG(median_minutes) OVER (ORDER BY year_month) - 1), 6) AS shift FROM m")
def distribution_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.month_changes(ship_months(spark, sf_dir), "median_minutes").select("year_month", "median_minutes", r(F.abs("relative"), 6).alias("shift"))


@query(f"""WITH {RESOLVED}, k AS (SELECT SUM(minutes) / 60 AS known, SUM(CASE WHEN reason = 'missing_uom' THEN amount ELSE 0 END) / 60 AS m, SUM(CASE WHEN reason = 'missing_uom' THEN amount * mpu ELSE 0 END) / 60 AS u, COUNT(*) FILTER (WHERE reason = 'missing_uom') AS n FROM resolved WHERE status = 'completed')
  SELECT n AS rows_without_unit, ROUND(known, 6) AS hours_excluded, ROUND(known + m, 6) AS hours_as_minutes, ROUND(known + u, 6) AS hours_as_units FROM k""")
def assumption_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = an.assumption_spread(resolved(spark, sf_dir), src.catalogue(spark))
    return a.select("rows_without_unit", *[r(c, 6).alias(c) for c in ("hours_excluded", "hours_as_minutes", "hours_as_units")])


# --- conforming --------------------------------------------------------------------------------------------------------


@query(f"WITH {RESOLVED} SELECT session_id, ROUND(minutes, 6) AS minutes, ROUND(units, 6) AS units, ok AS uom_resolved, reason AS unresolved_reason FROM resolved")
def resolve_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir).select("session_id", r("minutes", 6).alias("minutes"), r("units", 6).alias("units"), "uom_resolved", "unresolved_reason")


@query(f"WITH {SESSIONS}, cat AS (SELECT * FROM {CATALOGUE} WHERE service_code <> 'error') SELECT session_id, ROUND(CASE WHEN uom = 'units' THEN COALESCE(amount, 0) * COALESCE(mpu, 15) ELSE COALESCE(amount, 0) END, 6) AS minutes_naive FROM sessions LEFT JOIN cat USING (service_code)")
def resolve_units_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.resolve_units_naive(src.sessions(spark, sf_dir), src.catalogue(spark, without=("error",))).select("session_id", r("minutes_naive", 6).alias("minutes_naive"))


@query(f"WITH {RESOLVED} SELECT COALESCE(reason, 'resolved') AS reason, COUNT(*) AS sessions, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS pct FROM resolved GROUP BY 1")
def unresolved_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = resolved(spark, sf_dir).groupBy(F.coalesce("unresolved_reason", F.lit("resolved")).alias("reason")).agg(F.count(F.lit(1)).alias("sessions"))
    total = n.agg(F.sum("sessions").alias("total"))
    return n.crossJoin(F.broadcast(total)).select("reason", "sessions", r(F.col("sessions") * 100.0 / F.col("total")).alias("pct"))  # total has one row


LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
KEEP = f"SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM ({KEEP}) WHERE rn = 1")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = conform.keep_first(src.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("SELECT COUNT(*) AS submitted, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS kept, COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS dropped FROM lineitem")
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = src.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.sum("n").alias("submitted"), F.count(F.lit(1)).alias("kept"), F.sum(F.col("n") - 1).alias("dropped"))


VERSIONS = """v AS (SELECT o_custkey AS client_id, CAST(o_orderdate AS DATE) AS valid_from, o_orderpriority AS payer_id, o_orderkey,
  ROW_NUMBER() OVER w AS version, COALESCE(CAST(LEAD(CAST(o_orderdate AS DATE)) OVER w AS DATE) - 1, DATE '9999-12-31') AS valid_to, LEAD(o_orderkey) OVER w IS NULL AS is_current
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey))"""
SHIPPED = "shipped AS (SELECT o_custkey AS client_id, CAST(l_shipdate AS DATE) AS service_date, l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.scd2(src.changes(spark, sf_dir), "client_id", "effective_date", ["o_orderkey"])


@query(f"WITH {VERSIONS} SELECT client_id, CAST(version AS INTEGER) AS version, payer_id, valid_from, valid_to, is_current FROM v")
def scd2_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions(spark, sf_dir).select("client_id", "version", "payer_id", "valid_from", "valid_to", "is_current")


@query(f"WITH {VERSIONS}, {SHIPPED} SELECT v.payer_id, CAST(v.version AS INTEGER) AS version, COUNT(*) AS facts, ROUND(SUM(l_quantity), 2) AS quantity FROM shipped s JOIN v ON s.client_id = v.client_id AND s.service_date BETWEEN v.valid_from AND v.valid_to GROUP BY ALL")
def scd2_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = versions(spark, sf_dir).select("client_id", "version", "payer_id", "valid_from", "valid_to")
    j = conform.as_of(src.shipped(spark, sf_dir), v, "client_id", "service_date")
    return j.groupBy("payer_id", "version").agg(F.count(F.lit(1)).alias("facts"), r(F.sum("l_quantity"), 2).alias("quantity"))


@query(f"WITH {VERSIONS}, n AS (SELECT *, LEAD(valid_from) OVER (PARTITION BY client_id ORDER BY valid_from, version) AS nxt FROM v) SELECT COUNT(DISTINCT client_id) AS clients, COUNT(*) FILTER (WHERE is_current) AS current_rows, COUNT(*) FILTER (WHERE valid_to >= nxt) AS overlapping, COUNT(*) FILTER (WHERE valid_to < valid_from) AS empty FROM n")
def scd2_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.scd2_integrity(versions(spark, sf_dir), "client_id")


@query(f"""WITH {VERSIONS}, s AS (SELECT c_custkey AS client_id, DATE '1995-06-01' + CAST(c_custkey % 1000 AS INTEGER) AS on_date FROM customer), j AS (SELECT s.client_id, on_date, version, payer_id, COALESCE(on_date BETWEEN valid_from AND valid_to, FALSE) AS in_window,
  ROW_NUMBER() OVER (PARTITION BY s.client_id ORDER BY COALESCE(on_date BETWEEN valid_from AND valid_to, FALSE) DESC, valid_from NULLS LAST, version NULLS LAST) AS rn FROM s LEFT JOIN v ON s.client_id = v.client_id)
  SELECT client_id, on_date, CAST(version AS INTEGER) AS version, payer_id, in_window FROM j WHERE rn = 1""")
def asof_fallback_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = src.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust"), F.date_add(F.lit("1995-06-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias("on_date"))
    v = versions(spark, sf_dir).select("client_id", "version", "payer_id", "valid_from", "valid_to")
    return conform.as_of_or_earliest(c.withColumnRenamed("cust", "client_id"), v, "client_id", "on_date", "client_id").select("client_id", "on_date", "version", "payer_id", "in_window")


@query(f"WITH {VERSIONS}, {SHIPPED}, m AS (SELECT COUNT(*) AS n FROM shipped s JOIN v ON s.client_id = v.client_id AND s.service_date BETWEEN v.valid_from AND v.valid_to) SELECT (SELECT COUNT(*) FROM shipped) AS sessions, (SELECT n FROM m) AS facts, (SELECT COUNT(*) FROM shipped) - (SELECT n FROM m) AS lost")
def reconciliation_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = versions(spark, sf_dir).select("client_id", "version", "valid_from", "valid_to")
    return checks.reconciliation(src.shipped(spark, sf_dir), conform.as_of(src.shipped(spark, sf_dir), v, "client_id", "service_date"))


@query("SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend FROM generate_series((SELECT CAST(MIN(o_orderdate) AS DATE) FROM orders), (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY) AS t(d)")
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = src.table(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return conform.date_spine(spark, str(a), str(b))


@query("SELECT CAST(ROW_NUMBER() OVER (ORDER BY s_suppkey) AS INTEGER) AS supplier_key, s_suppkey, s_name FROM supplier")
def dim_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.surrogate_keys(src.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"], "supplier_key")


@query(f"WITH d AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY service_code) AS INTEGER) AS service_key, service_code FROM {CATALOGUE} WHERE service_code <> 'error') SELECT COALESCE(service_key, 0) AS service_key, COUNT(*) AS sessions FROM events LEFT JOIN d ON event_type = service_code GROUP BY 1")
def unknown_member_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = conform.surrogate_keys(src.catalogue(spark, without=("error",)).select("service_code"), ["service_code"], "service_key")
    j = conform.lookup(src.sessions(spark, sf_dir), dim, "service_code", ["service_key"], {"service_key": 0})
    return j.groupBy("service_key").agg(F.count(F.lit(1)).alias("sessions"))


# --- windows, shares, ranks --------------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 60 AS e FROM orders), m AS (SELECT *, MAX(e) OVER (PARTITION BY o_custkey ORDER BY s, e, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_end FROM p)
  SELECT o_orderkey, o_custkey, s AS period_start, e AS period_end, prior_end FROM m WHERE s <= prior_end""")
def overlap_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("period_start"), F.date_add(F.to_date("o_orderdate"), 60).alias("period_end"))
    return an.overlaps(o, ["o_custkey"], "period_start", "period_end", "o_orderkey")


@query("SELECT n_name, c_mktsegment, COUNT(*) AS n, CAST(RANK() OVER (PARTITION BY n_name ORDER BY COUNT(*) DESC) AS INTEGER) AS rank, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY n_name), 6) AS pct FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment")
def rank_and_share_within_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = src.table(spark, sf_dir, "customer"), src.table(spark, sf_dir, "nation")
    s = an.share_and_rank(c.join(n, c.c_nationkey == n.n_nationkey), "n_name", "c_mktsegment")
    return s.select("n_name", "c_mktsegment", "n", "rank", r("pct").alias("pct"))


@query("SELECT l_suppkey, ROUND(SUM(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY l_suppkey ORDER BY revenue DESC, l_suppkey LIMIT 10")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = src.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(r(F.sum("l_extendedprice"), 2).alias("revenue"))
    return t.orderBy(F.col("revenue").desc(), "l_suppkey").limit(10)


@query("""WITH m AS (SELECT strftime(l_shipdate, '%Y-%m') AS year_month, SUM(l_quantity) AS q FROM lineitem GROUP BY 1) SELECT year_month, q AS quantity, LAG(q) OVER (ORDER BY year_month) AS quantity_last_month, ROUND((q - LAG(q) OVER (ORDER BY year_month)) / LAG(q) OVER (ORDER BY year_month), 6) AS mom FROM m""")
def month_over_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = src.table(spark, sf_dir, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("year_month")).agg(F.sum("l_quantity").alias("quantity"))
    return an.month_changes(m, "quantity").select("year_month", "quantity", F.col("previous").alias("quantity_last_month"), r("relative", 6).alias("mom"))


@query(f"WITH {UTIL} SELECT CASE WHEN delivered / NULLIF(expected, 0) > 1 THEN 'over-delivered' WHEN delivered / NULLIF(expected, 0) >= 0.9 THEN 'on track' WHEN delivered / NULLIF(expected, 0) >= 0.75 THEN 'behind' WHEN delivered / NULLIF(expected, 0) IS NOT NULL THEN 'at risk' END AS pace_status, COUNT(*) AS authorizations FROM util GROUP BY 1")
def pace_status_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("pace")
    status = F.when(p > 1, "over-delivered").when(p >= 0.9, "on track").when(p >= 0.75, "behind").when(p.isNotNull(), "at risk")
    return util(spark, sf_dir).groupBy(status.alias("pace_status")).agg(F.count(F.lit(1)).alias("authorizations"))


@query(f"WITH {UTIL} SELECT strftime(p_end, '%Y-%m') AS end_month, COUNT(*) AS expiring, ROUND(SUM(hours_unused), 6) AS hours_unused FROM util GROUP BY 1")
def expiring_by_end_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return util(spark, sf_dir).groupBy(F.date_format("period_end", "yyyy-MM").alias("end_month")).agg(F.count(F.lit(1)).alias("expiring"), r(F.sum("hours_unused"), 6).alias("hours_unused"))


@query("""WITH a AS (SELECT SUM(o_totalprice) AS right_total FROM orders), b AS (SELECT SUM(o_totalprice) AS wrong_total FROM orders JOIN lineitem ON o_orderkey = l_orderkey) SELECT ROUND(right_total, 0) AS right_total, ROUND(wrong_total, 0) AS wrong_total, ROUND(wrong_total / right_total, 6) AS inflation FROM a, b""")
def fanout_inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total of a coarse grain, and what it becomes when joined to a finer one: counted before the join, so no row is multiplied."""
    o = src.table(spark, sf_dir, "orders")
    n = src.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    t = o.join(n, "o_orderkey", "left").agg(F.sum("o_totalprice").alias("a"), F.sum(F.col("o_totalprice") * F.coalesce("n", F.lit(0))).alias("b"))
    return t.select(r("a", 0).alias("right_total"), r("b", 0).alias("wrong_total"), r(ratio(F.col("b"), F.col("a"))).alias("inflation"))


# --- metrics, quality, privacy -----------------------------------------------------------------------------------------

METRIC_SQL = {
    "units_authorized": "SELECT SUM(authorized) FROM util", "units_delivered_completed": "SELECT SUM(units) FROM resolved WHERE status = 'completed'", "hours_delivered": "SELECT SUM(minutes) / 60 FROM resolved WHERE status = 'completed' AND ok",
    "session_count": "SELECT COUNT(DISTINCT session_id) FROM resolved", "authorization_count": "SELECT COUNT(DISTINCT auth_id) FROM util", "children_served": "SELECT COUNT(DISTINCT client_id) FROM resolved", "auth_units_delivered": "SELECT SUM(delivered) FROM util",
    "units_unused": "SELECT SUM(unused) FROM util", "hours_unused": "SELECT SUM(hours_unused) FROM util", "hours_authorized": "SELECT SUM(hours_authorized) FROM util", "authorization_utilization": "SELECT SUM(delivered) / SUM(authorized) FROM util",
}


@query(f"WITH {UTIL} " + " UNION ALL ".join(f"SELECT '{k}' AS metric, ROUND(CAST(({q}) AS DOUBLE), 6) AS value, TRUE AS agrees" for k, q in METRIC_SQL.items()))
def metric_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = metrics.parity({"sessions": resolved(spark, sf_dir), "utilization": util(spark, sf_dir)})
    return p.select("metric", r("frame_value", 6).alias("value"), "agrees")


@query(f"""WITH {UTIL}, x AS (SELECT (SELECT AVG(CAST(ok AS INTEGER)) FROM resolved) AS coverage, (SELECT COUNT(*) FROM resolved WHERE status = 'completed' AND ok AND (minutes < 5 OR minutes > 480)) AS implausible, (SELECT COUNT(*) FROM resolved WHERE mpu IS NULL) AS unmapped, (SELECT COUNT(*) FROM util WHERE utilization > 1) AS over_ceiling, (SELECT COUNT(*) FROM util WHERE authorized = 0 AND delivered > 0) AS zero_units)
  SELECT 'uom_resolution_coverage' AS name, 'BLOCK' AS severity, coverage >= 0.99 AS passed, ROUND(coverage, 6) AS observed FROM x UNION ALL SELECT 'duration_plausibility', 'BLOCK', implausible = 0, implausible FROM x
  UNION ALL SELECT 'unmapped_service_codes', 'WARN', unmapped = 0, unmapped FROM x UNION ALL SELECT 'utilization_over_ceiling', 'WARN', over_ceiling = 0, over_ceiling FROM x UNION ALL SELECT 'zero_unit_authorizations', 'WARN', zero_units = 0, zero_units FROM x""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.core_checks(resolved(spark, sf_dir), util(spark, sf_dir), src.catalogue(spark, without=("error",))).select("name", "severity", "passed", r("observed", 6).alias("observed"))


def _hmac_sql(column: str, key: bytes) -> str:
    block = key.ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in block).hex() for x in (0x36, 0x5C))
    return f"upper(substr(sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(CAST({column} AS VARCHAR))))), 1, 12))"


@query(f"SELECT c_custkey, 'CLI-' || {_hmac_sql('c_custkey', KEY)} AS pseudonym FROM customer")
def pseudonymise_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.table(spark, sf_dir, "customer").select("c_custkey", pseudonym(F.col("c_custkey"), KEY, "CLI").alias("pseudonym"))


#: The patterns without look-around, which the oracle's engine lacks.
SCANNED = {"ssn": r"\b\d{3}-\d{2}-\d{4}\b", "email": r"\b[\w.+-]+@[\w-]+\.[\w.]{2,}\b", "date_of_birth": r"\b(?:0?[1-9]|1[0-2])[/-](?:0?[1-9]|[12]\d|3[01])[/-](?:19|20)\d{2}\b", "us_zip_plus4": r"\b\d{5}-\d{4}\b", "mrn_like": r"(?i)\b(?:MRN|MR#|MEDREC|MEDICAL\s+RECORD)(?:\s*(?:ID|NO|NUM|NUMBER|#))?[ .:#-]*\w{4,}\b"}


@query(" UNION ALL ".join(f"SELECT 'text' AS \"column\", '{n}' AS pattern, COUNT(*) AS matches FROM documents WHERE regexp_matches(text, '{p}') HAVING COUNT(*) > 0" for n, p in SCANNED.items()))
def content_scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.scan(src.table(spark, sf_dir, "documents").select("text"), SCANNED).select("column", "pattern", "matches")


SUPPRESSED = """WITH n AS (SELECT {g} AS g, {l} AS label, COUNT(*) // {d} AS n FROM {t} GROUP BY 1, 2), p AS (SELECT *, n > 0 AND n <= 10 AS small FROM n), q AS (SELECT *, COUNT(*) FILTER (WHERE small) OVER (PARTITION BY g) AS hidden, ROW_NUMBER() OVER (PARTITION BY g ORDER BY small, n, label) AS rn FROM p)
  SELECT g, label, CASE WHEN small OR (hidden = 1 AND NOT small AND rn = 1) THEN '<11' ELSE CAST(n AS VARCHAR) END AS n, small OR (hidden = 1 AND NOT small AND rn = 1) AS suppressed FROM q WHERE g IS NOT NULL"""


def counted(spark: SparkSession, sf_dir: str, t: str, g: str, label: str, d: int) -> DataFrame:
    return src.table(spark, sf_dir, t).groupBy(F.expr(g).alias("g"), F.expr(label).alias("label")).agg(F.expr(f"COUNT(*) DIV {d}").alias("n"))


@query(SUPPRESSED.format(g="1", l="event_type", d=180, t="events"))
def suppress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.suppress(counted(spark, sf_dir, "events", "1", "event_type", 180), "n", "label", group="g").select("g", "label", "n", "suppressed")


@query(SUPPRESSED.format(g="NULLIF(c_nationkey, 3)", l="c_mktsegment", d=1, t="customer"))
def suppress_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.suppress(counted(spark, sf_dir, "customer", "NULLIF(c_nationkey, 3)", "c_mktsegment", 1), "n", "label", group="g").select("g", "label", "n", "suppressed")


# --- versions of a table -----------------------------------------------------------------------------------------------

AFTER = "after AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 13 <> 0 UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 17 = 0)"
DIFF = f"WITH {AFTER}, j AS (SELECT b.o_orderkey AS bk, a.o_orderkey AS ak, b.o_orderkey IS NOT NULL AND a.o_orderkey IS NOT NULL AS matched, b.o_custkey IS DISTINCT FROM a.o_custkey AS d1, b.o_orderstatus IS DISTINCT FROM a.o_orderstatus AS d2, b.o_totalprice IS DISTINCT FROM a.o_totalprice AS d3 FROM orders b FULL JOIN after a ON b.o_orderkey = a.o_orderkey)"


def before_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    kept = o.where("o_orderkey % 13 <> 0").withColumn("o_orderstatus", F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END")).withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"))
    return o, kept.unionByName(o.where("o_orderkey % 17 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1))


@query(f"{DIFF} SELECT COUNT(*) FILTER (WHERE bk IS NULL) AS added, COUNT(*) FILTER (WHERE ak IS NULL) AS removed, COUNT(*) FILTER (WHERE matched AND (d1 OR d2 OR d3)) AS changed, COUNT(*) FILTER (WHERE matched AND NOT (d1 OR d2 OR d3)) AS unchanged FROM j")
def diff_added_removed_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.diff_summary(*before_after(spark, sf_dir), ["o_orderkey"]).select("added", "removed", "changed", "unchanged")


@query(f"{DIFF} SELECT 'o_custkey' AS \"column\", COUNT(*) FILTER (WHERE matched AND d1) AS changed FROM j UNION ALL SELECT 'o_orderstatus', COUNT(*) FILTER (WHERE matched AND d2) FROM j UNION ALL SELECT 'o_totalprice', COUNT(*) FILTER (WHERE matched AND d3) FROM j")
def changed_cells_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.diff_cells(*before_after(spark, sf_dir), ["o_orderkey"])


@query()
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.fingerprint(src.table(spark, sf_dir, "orders"))


@query("SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-18' THEN value + 1 ELSE value END AS value FROM events")
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load to 25 January, then a batch from the mark less seven days, corrected: as a full load would be."""
    from datetime import date

    e = src.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "value")
    first = e.where("day <= '2024-01-25'")
    batch = ch.select_window(e, "day", date(2024, 1, 25), 7).withColumn("value", F.col("value") + 1)
    return ch.merged(first, batch, ["event_id"]).select("event_id", "value")


@query("SELECT COUNT(*) AS rows, MIN(CAST(ts AS DATE)) AS first_day, MAX(CAST(ts AS DATE)) AS last_day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-18'")
def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import date

    e = src.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    return ch.select_window(e, "day", date(2024, 1, 25), 7).agg(F.count(F.lit(1)).alias("rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


# --- the SQL corpus ----------------------------------------------------------------------------------------------------

#: Written apart from the statements that they check: from the raw tables, without the star.
MONTH = "strftime(service_date, '%Y-%m')"
SERVICE = "CASE WHEN service_code = 'error' THEN 'UNKNOWN' ELSE service_code END"
CONTRACT = "CASE WHEN client_id % 2 = 1 THEN 'value_based' ELSE 'fee_for_service' END"
CORPUS_ORACLES = {
    "corpus_q01_monthly_volume": f"WITH {RESOLVED} SELECT {MONTH} AS year_month, COUNT(*) AS sessions, COUNT(*) FILTER (WHERE status = 'completed') AS completed, ROUND(SUM(minutes) FILTER (WHERE status = 'completed') / 60, 1) AS hours_delivered, ROUND(AVG(CAST(ok AS INTEGER)) FILTER (WHERE status = 'completed'), 4) AS uom_coverage FROM resolved GROUP BY 1",
    "corpus_q02_lowest_utilization": f"WITH {UTIL} SELECT auth_id, client_id, {SERVICE} AS service_code, CASE WHEN service_code IN ('view', 'click') THEN 'front' WHEN service_code = 'error' THEN 'UNKNOWN' ELSE 'back' END AS discipline, 'Payer ' || CAST(client_id % 4 AS VARCHAR) AS payer_name, {CONTRACT} AS contract_type, authorized AS units_authorized, ROUND(delivered, 4) AS units_delivered, ROUND(utilization, 4) AS utilization FROM util ORDER BY util.utilization NULLS FIRST, auth_id LIMIT 25",
    "corpus_q03_fanned_out_total": f"WITH {RESOLVED}, {AUTHS}, wide AS (SELECT a.authorized FROM auths a, resolved s WHERE s.client_id = a.client_id AND s.service_code = a.service_code AND s.service_date >= a.p_start AND s.service_date <= a.p_end AND s.status = 'completed' AND s.ok) SELECT (SELECT SUM(authorized) FROM auths) AS authorized_units_correct, SUM(authorized) AS authorized_units_fanned_out, ROUND(SUM(authorized) / (SELECT SUM(authorized) FROM auths), 1) AS inflation_factor FROM wide",
    "corpus_q04_resolution_by_month": f"WITH {RESOLVED}, t AS (SELECT {MONTH} AS year_month, COUNT(*) AS total FROM resolved GROUP BY 1) SELECT t.year_month, CASE WHEN ok THEN 'resolved' ELSE reason END AS resolution, COUNT(*) AS sessions, ROUND(100.0 * COUNT(*) / total, 2) AS pct_of_month FROM resolved JOIN t ON t.year_month = {MONTH} GROUP BY t.year_month, 2, total",
    "corpus_q05_weighted_and_mean_ratio": f"WITH {UTIL} SELECT {CONTRACT} AS contract_type, COUNT(DISTINCT auth_id) AS authorizations, ROUND(SUM(delivered) / SUM(authorized), 4) AS utilization_weighted, ROUND(AVG(utilization), 4) AS utilization_mean_of_ratios FROM util GROUP BY 1",
    "corpus_q06_history_read_back": """WITH people AS (SELECT DISTINCT user_id AS client_id FROM events WHERE user_id % 3 = 0),
  v AS (SELECT client_id, 1 AS version, client_id % 4 AS payer_id, 'enrollment' AS change_reason, DATE '2024-01-01' AS valid_from, DATE '2024-01-15' AS valid_to, FALSE AS is_current FROM people UNION ALL SELECT client_id, 2, (client_id + 1) % 4, 'payer_change', DATE '2024-01-16', DATE '9999-12-31', TRUE FROM people)
  SELECT v.*, (SELECT COUNT(*) FROM events e WHERE e.user_id = v.client_id AND CAST(e.ts AS DATE) >= v.valid_from AND CAST(e.ts AS DATE) <= v.valid_to) AS sessions_in_version FROM v ORDER BY client_id, version LIMIT 30""",
    "corpus_q07_expiring_unused": f"""WITH {UTIL}, today AS (SELECT MAX(CAST(ts AS DATE)) AS d FROM events)
  SELECT auth_id, client_id, {SERVICE} AS service_code, 'Payer ' || CAST(client_id % 4 AS VARCHAR) AS payer_name, p_end AS expires_on, CAST(p_end - d AS INTEGER) AS days_to_expiry, ROUND(authorized * mpu / 60, 1) AS hours_authorized, ROUND(delivered * mpu / 60, 1) AS hours_delivered, ROUND((authorized - delivered) * mpu / 60, 1) AS hours_at_risk
  FROM util, today WHERE d BETWEEN p_start AND p_end AND p_end - d <= 30 AND authorized > 0 AND authorized - delivered >= 0.25 * authorized ORDER BY 6, 9 DESC, 1 LIMIT 30""",
    "corpus_q08_provider_rank": f"""WITH {RESOLVED}, n AS (SELECT provider_id, CASE WHEN provider_id % 2 = 0 THEN 'front' ELSE 'back' END AS discipline, COUNT(*) AS sessions, SUM(minutes) AS minutes FROM resolved WHERE status = 'completed' GROUP BY 1)
  SELECT a.provider_id, CASE WHEN a.provider_id % 3 = 0 THEN 'lead' ELSE 'staff' END AS role, a.discipline, a.sessions, ROUND(a.minutes / 60, 1) AS hours, CAST(1 + COUNT(*) FILTER (WHERE b.sessions > a.sessions) AS INTEGER) AS rank_in_discipline, ROUND(100.0 * a.sessions / SUM(b.sessions), 2) AS pct_of_discipline
  FROM n a JOIN n b ON a.discipline = b.discipline GROUP BY a.provider_id, a.discipline, a.sessions, a.minutes""",
    "corpus_q09_where_and_having": """WITH c AS (SELECT user_id % 5 AS centre, COUNT(*) AS a, SUM(CASE WHEN event_id % 25 > 2 THEN 1 ELSE 0 END) AS c, SUM(CASE WHEN event_id % 25 = 0 THEN 1 ELSE 0 END) AS n FROM events GROUP BY 1)
  SELECT 'Centre ' || CAST(centre AS VARCHAR) AS center_name, a AS all_sessions, CAST(c AS BIGINT) AS completed_sessions, CAST(n AS BIGINT) AS no_shows, ROUND(100.0 * n / a, 2) AS no_show_pct_all_rows, ROUND(100.0 * n / NULLIF(c, 0), 2) AS no_show_pct_completed_only FROM c WHERE a > 100""",
    "corpus_q10_newest_runs": """SELECT strftime(CAST(ts AS DATE), 'run-%Y%m%d') AS run_id, CAST(ts AS DATE) + 1 AS finished_at, MAX(event_id) % 3 <> 0 AS published, CASE WHEN MAX(event_id) % 3 = 0 THEN 'uom_resolution_coverage' END AS blocking, COUNT(*) AS rows FROM events GROUP BY CAST(ts AS DATE) ORDER BY CAST(ts AS DATE) DESC LIMIT 10""",
}


for _name in corpus.QUERIES:
    QUERIES[_name] = lambda spark, sf_dir, n=_name: corpus.run(spark, sf_dir, n)
    ORACLES[_name] = CORPUS_ORACLES[_name]

from unitflow import queries_more as _more  # noqa: E402, F401  registers its queries here
