"""Roll-ups of delivery to the grain of entitlements, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unitflow.functions.exprs import addends, at_least, clipped, ratio, total, year_month

FLOOR, CEILING, EXPIRY_DAYS, UNUSED_SHARE = 0.90, 1.00, 30, 0.25


def eligible(sessions: DataFrame) -> DataFrame:
    return sessions.where("status = 'completed' AND uom_resolved")


def roll_up(auths: DataFrame, sessions: DataFrame, keys: tuple[str, ...] = ("client_id", "service_code")) -> DataFrame:
    """units_delivered, minutes_delivered and sessions of each authorisation: completed and resolved sessions of its keys within
    its period, both ends in it.

    Sessions are summed by keys and day first, so the join sees a day at most once a key; the range is a residual of the
    equi-join. Authorisations without sessions stay, with zeros. Units and minutes are summed as decimals, so neither the days nor
    the order of the rows shows in the result.
    """
    (u, u_rest), (m, m_rest) = addends(F.col("units")), addends(F.col("minutes"))
    days = eligible(sessions).groupBy(*keys, "service_date").agg(
        F.sum(u).alias("_u"), F.sum(u_rest).alias("_ur"), F.sum(m).alias("_m"), F.sum(m_rest).alias("_mr"), F.countDistinct("session_id").alias("_n"),
    )
    a, d = auths.alias("a"), days.alias("d")
    on = F.col("d.service_date").between(F.col("a.period_start"), F.col("a.period_end"))
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"d.{k}"))
    sums = a.join(d, on).groupBy("a.auth_id").agg(total(F.sum("_u"), F.sum("_ur")).alias("units_delivered"), total(F.sum("_m"), F.sum("_mr")).alias("minutes_delivered"), F.sum("_n").alias("sessions"))
    zero = {"units_delivered": 0.0, "minutes_delivered": 0.0, "sessions": 0}
    return auths.join(sums, "auth_id", "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in zero.items()})


def utilization(auths: DataFrame, sessions: DataFrame, catalogue: DataFrame, as_of: Column) -> DataFrame:
    """One row an authorisation: utilisation, unused units and hours, expiry, elapsed share, expected units, pace and performance as of a date.

    Undefined ratios are null. A closed authorisation's performance is its utilisation, an open one's its pace.
    """
    u = roll_up(auths, sessions).join(catalogue.select("service_code", F.col("minutes_per_unit").cast("double").alias("mpu")), "service_code", "left")
    mpu = F.coalesce("mpu", F.lit(0.0))
    days = F.datediff("period_end", "period_start") + 1
    elapsed = at_least(F.datediff(F.least(F.col("period_end"), as_of), "period_start") + 1, 0)
    u = u.withColumns({
        "utilization": ratio(F.col("units_delivered"), F.col("units_authorized")),
        "units_unused": F.greatest(F.col("units_authorized") - F.col("units_delivered"), F.lit(0.0)),
        "hours_authorized": F.col("units_authorized") * mpu / 60,
        "days_to_expiry": F.datediff("period_end", as_of),
        "is_active": (F.col("period_start") <= as_of) & (as_of <= F.col("period_end")),
        "is_closed": F.col("period_end") < as_of,
        "authorized_days": days,
        "elapsed_days": elapsed,
        "elapsed_fraction": clipped(ratio(elapsed, days), 0.0, 1.0),
    })
    u = u.withColumn("hours_unused", F.col("units_unused") * mpu / 60).withColumn("expected_units", F.col("units_authorized") * F.col("elapsed_fraction"))
    u = u.withColumn("pace", ratio(F.col("units_delivered"), F.col("expected_units")))
    return u.withColumn("performance", F.when(F.col("is_closed"), F.col("utilization")).otherwise(F.col("pace"))).drop("mpu")


def with_payer_and_home(u: DataFrame, payers: DataFrame, clients: DataFrame, centers: DataFrame) -> DataFrame:
    """Adds payer_name and contract_type of the authorisation's payer, and home_center_id and center_name of the client's current version; one row an authorisation."""
    home = clients.where("is_current").groupBy("client_id").agg(F.min("home_center_id").alias("home_center_id"))
    named = home.join(centers.select(F.col("center_id").alias("home_center_id"), "center_name"), "home_center_id", "left")
    # a payer listed with two contracts must not make two rows
    one = payers.groupBy("payer_id").agg(F.min(F.struct("payer_name", "contract_type")).alias("p")).select("payer_id", "p.payer_name", "p.contract_type")
    return u.join(one, "payer_id", "left").join(named, "client_id", "left")


def role_months(auths: DataFrame, dates: DataFrame) -> DataFrame:
    """auth_id, start_month, end_month: the date dimension in two roles."""
    start = dates.select(F.col("full_date").alias("period_start"), F.col("year_month").alias("start_month"))
    end = dates.select(F.col("full_date").alias("period_end"), F.col("year_month").alias("end_month"))
    return auths.join(start, "period_start", "left").join(end, "period_end", "left").select("auth_id", "start_month", "end_month")


def sibling_versions(clients: DataFrame) -> DataFrame:
    """Pairs of versions of one client (a self-join by the natural key), with the payer before and after."""
    a = clients.select("client_id", F.col("version").alias("earlier"), F.col("payer_id").alias("payer_before"))
    b = clients.select("client_id", F.col("version").alias("later"), F.col("payer_id").alias("payer_after"))
    return a.join(b, "client_id").where(F.col("later") == F.col("earlier") + 1)


def first_rows(rows: DataFrame, group: str, order: list, limit: int) -> DataFrame:
    """The first ``limit`` rows of each group, with their rank and how many more the group has."""
    w = Window.partitionBy(group)
    ranked = rows.withColumns({"rank": F.row_number().over(w.orderBy(*order)), "_n": F.count(F.lit(1)).over(w)})
    return ranked.where(F.col("rank") <= limit).withColumn("more", F.greatest(F.col("_n") - limit, F.lit(0))).drop("_n")


def unmatched(sessions: DataFrame, auths: DataFrame, keys: tuple[str, ...] = ("client_id", "service_code")) -> DataFrame:
    """Eligible sessions that no authorisation covers."""
    s, a = eligible(sessions).alias("s"), auths.alias("a")
    on = F.col("s.service_date").between(F.col("a.period_start"), F.col("a.period_end"))
    for k in keys:
        on = on & (F.col(f"s.{k}") == F.col(f"a.{k}"))
    return s.join(a, on, "left_anti")


def at_risk(u: DataFrame, days: int = EXPIRY_DAYS, share: float = UNUSED_SHARE) -> DataFrame:
    """Open authorisations that end within ``days`` with ``share`` of their units unused."""
    return u.where(F.col("is_active") & F.col("days_to_expiry").between(0, days) & (F.col("units_authorized") > 0) & (ratio(F.col("units_unused"), F.col("units_authorized")) >= share))


def by_dimension(u: DataFrame, dimension: str) -> DataFrame:
    """Weighted ratios by a dimension; its null is a group like any other."""
    return (
        u.groupBy(dimension)
        .agg(
            F.count(F.lit(1)).alias("authorizations"), F.countDistinct("client_id").alias("clients"), F.sum("units_authorized").alias("units_authorized"), F.sum("units_delivered").alias("units_delivered"),
            F.sum("expected_units").alias("expected_units"), F.sum("hours_unused").alias("hours_unused"),
        )
        .withColumn("utilization", ratio(F.col("units_delivered"), F.col("units_authorized")))
        .withColumn("pace", ratio(F.col("units_delivered"), F.col("expected_units")))
    )


def monthly_delivery(sessions: DataFrame) -> DataFrame:
    """Completed sessions by month; the median is of resolved rows only."""
    done = sessions.where("status = 'completed'").withColumn("year_month", year_month(F.col("service_date")))
    return done.groupBy("year_month").agg(
        F.countDistinct("client_id").alias("clients"), F.count(F.lit(1)).alias("sessions"), F.sum("units").alias("units"), (F.sum("minutes") / 60).alias("hours"), F.count_if("uom_resolved").alias("resolved"),
        F.avg(F.col("uom_resolved").cast("double")).alias("coverage"), F.median(F.when(F.col("uom_resolved"), F.col("minutes"))).alias("median_minutes"),
    )


def coverage_by_month(sessions: DataFrame) -> DataFrame:
    return sessions.where("status = 'completed'").groupBy(year_month(F.col("service_date")).alias("year_month")).agg(F.avg(F.col("uom_resolved").cast("double")).alias("coverage"))


def assumption_spread(resolved: DataFrame, catalogue: DataFrame, default: float = 15.0) -> DataFrame:
    """What completed rows without a unit would be worth in hours if taken for minutes, for units, or left out."""
    from unitflow.functions.exprs import number

    m = F.coalesce(F.col("minutes_per_unit").cast("double"), F.lit(default))
    j = resolved.where("status = 'completed'").join(catalogue.select("service_code", "minutes_per_unit"), "service_code", "left")
    amount = F.when(F.col("unresolved_reason") == "missing_uom", F.coalesce(number(F.col("duration_value")), F.lit(0.0))).otherwise(0.0)
    known = F.sum("minutes") / 60
    return j.agg(
        F.count_if(F.col("unresolved_reason") == "missing_uom").alias("rows_without_unit"), known.alias("hours_excluded"), (known + F.sum(amount) / 60).alias("hours_as_minutes"), (known + F.sum(amount * m) / 60).alias("hours_as_units"),
    )


def headline(u: DataFrame) -> DataFrame:
    """One row of totals over open and closed authorisations."""
    open_, risk = ~F.col("is_closed"), F.col("is_active") & F.col("days_to_expiry").between(0, EXPIRY_DAYS) & (F.col("units_authorized") > 0) & (ratio(F.col("units_unused"), F.col("units_authorized")) >= UNUSED_SHARE)
    total = lambda c, on: F.sum(F.when(on, F.col(c)))
    return u.agg(
        F.count_if(open_).alias("open_auths"), F.count_if(F.col("is_closed")).alias("closed_auths"), total("hours_unused", open_).alias("hours_unused_open"),
        ratio(total("units_delivered", open_), total("expected_units", open_)).alias("pace_open"), ratio(total("units_delivered", F.col("is_closed")), total("units_authorized", F.col("is_closed"))).alias("utilization_closed"),
        F.count_if(risk).alias("at_risk"), total("hours_unused", risk).alias("hours_at_risk"), F.countDistinct(F.when(risk, F.col("client_id"))).alias("clients_at_risk"),
    )


def overlaps(periods: DataFrame, keys: list[str], start: str, end: str, tie: str) -> DataFrame:
    """Periods that begin on or before the latest end of an earlier one of their key: a running maximum, no self-join."""
    w = Window.partitionBy(*keys).orderBy(start, end, tie).rowsBetween(Window.unboundedPreceding, -1)
    return periods.withColumn("prior_end", F.max(end).over(w)).where(F.col(start) <= F.col("prior_end"))


def month_changes(monthly: DataFrame, value: str, month: str = "year_month") -> DataFrame:
    """Adds previous, change and relative change by month. One row a month, so one task orders them."""
    w = Window.orderBy(month)
    prev = F.lag(value).over(w)
    return monthly.withColumn("previous", prev).withColumn("change", F.col(value) - F.col("previous")).withColumn("relative", ratio(F.col("change"), F.col("previous")))


def worst_drop(monthly: DataFrame, value: str = "coverage", month: str = "year_month", step: float = 0.02) -> DataFrame:
    """The largest fall from a month to the next, whether it exceeds ``step``, and whether later months stayed below and earlier ones were above."""
    c = month_changes(monthly, value, month).withColumn("drop", -F.col("change"))
    w = Window.orderBy(F.col("drop").desc_nulls_last(), month)
    worst = c.withColumn("_r", F.row_number().over(w)).where("_r = 1 AND drop IS NOT NULL").select(F.col(month).alias("worst_month"), F.col("previous").alias("before"), F.col(value).alias("after"), F.col("drop"))
    half = worst.withColumn("_half", (F.col("before") + F.col("after")) / 2)
    j = monthly.crossJoin(F.broadcast(half))  # half has one row
    return j.groupBy("worst_month", "before", "after", "drop").agg(
        F.every(F.when(F.col(month) >= F.col("worst_month"), F.col(value) < F.col("_half"))).alias("persisted"), F.every(F.when(F.col(month) < F.col("worst_month"), F.col(value) > F.col("_half"))).alias("clean_before"),
    ).withColumn("exceeds", F.col("drop") > step)


def share_and_rank(rows: DataFrame, group: str, item: str) -> DataFrame:
    """Counts by (group, item), with rank and percentage within the group."""
    n = rows.groupBy(group, item).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("rank", F.rank().over(Window.partitionBy(group).orderBy(F.col("n").desc()))).withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(group)))
