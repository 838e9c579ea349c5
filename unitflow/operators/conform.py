"""Conforming raw rows: units, duplicates, dimension history and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from unitflow.functions.exprs import FAR_FUTURE, date_key, normalised, number

UNKNOWN_KEY = 0


def resolve_units(rows: DataFrame, catalogue: DataFrame, code: str = "service_code", value: str = "duration_value", uom: str = "duration_uom") -> DataFrame:
    """Adds minutes, units, uom_resolved and unresolved_reason. Nothing is guessed.

    A row is resolved if its unit is "minutes" or "units", its value is a number and ``catalogue`` (``code``, minutes_per_unit) has
    its code. Of several reasons the first of these is given: non_numeric_duration, unmapped_service_code, missing_uom,
    unrecognised_uom. Unresolved rows have 0 minutes and units. A catalogue fits a broadcast by its nature; the planner decides.
    """
    known = catalogue.select(F.col(code).alias("_code"), F.col("minutes_per_unit").cast("double").alias("_mpu"))
    j = rows.join(known, rows[code].cast("string") == F.col("_code").cast("string"), "left")
    unit, amount = normalised(F.col(uom)), number(F.col(value))
    mapped = F.col("_mpu") > 0
    reason = (
        F.when(amount.isNull(), "non_numeric_duration")
        .when(~F.coalesce(mapped, F.lit(False)), "unmapped_service_code")
        .when(unit == "", "missing_uom")
        .when(~unit.isin("minutes", "units"), "unrecognised_uom")
    )
    minutes = F.when(unit == "minutes", amount).when(unit == "units", amount * F.col("_mpu"))
    units = F.when(unit == "minutes", amount / F.col("_mpu")).when(unit == "units", amount)  # units by way of minutes would not all come back as they were
    out = j.withColumn("unresolved_reason", reason).withColumn("uom_resolved", F.col("unresolved_reason").isNull())
    out = out.withColumn("minutes", F.when(F.col("uom_resolved"), minutes).otherwise(0.0))
    return out.withColumn("units", F.when(F.col("uom_resolved"), units).otherwise(0.0)).drop("_code", "_mpu")


def resolve_units_naive(rows: DataFrame, catalogue: DataFrame, code: str = "service_code", value: str = "duration_value", uom: str = "duration_uom", default: float = 15.0) -> DataFrame:
    """Adds minutes_naive: a missing unit is taken for minutes. Kept to price that guess."""
    known = catalogue.select(F.col(code).alias("_code"), F.col("minutes_per_unit").cast("double").alias("_mpu"))
    j = rows.join(known, rows[code].cast("string") == F.col("_code").cast("string"), "left")
    amount = F.coalesce(number(F.col(value)), F.lit(0.0))
    guess = F.when(normalised(F.col(uom)) == "units", amount * F.coalesce("_mpu", F.lit(default))).otherwise(amount)
    return j.withColumn("minutes_naive", guess).drop("_code", "_mpu")


def ranked(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Adds _rank from 1 within equal keys (nulls are equal to each other)."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keep_first(rows: DataFrame, keys: list[str], order: list) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): of rows equal in ``keys`` the first in ``order`` stays."""
    r = ranked(rows, keys, order)
    return r.where("_rank = 1").drop("_rank"), r.where("_rank > 1").drop("_rank")


def scd2(changes: DataFrame, key: str, effective: str, tie: list[str]) -> DataFrame:
    """Versions of each key: version, valid_from, valid_to (the day before the next, or far in the future), is_current.

    Changes of one day are ordered by ``tie``; all but the last get an empty validity, which no as-of join meets.
    """
    w = Window.partitionBy(key).orderBy(effective, *tie)
    nxt = F.lead(effective).over(w)
    return (
        changes.withColumn("version", F.row_number().over(w))
        .withColumn("valid_from", F.col(effective))
        .withColumn("valid_to", F.coalesce(F.date_sub(nxt, 1), F.lit(FAR_FUTURE).cast("date")))
        .withColumn("is_current", nxt.isNull())
    )


def surrogate_keys(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Dense keys from 1. For dimensions: one task numbers the rows."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def with_unknown(dim: DataFrame, key: str, values: dict) -> DataFrame:
    """The dimension and its unknown member, key 0."""
    member = dim.sparkSession.range(1).select(*[F.lit(UNKNOWN_KEY if f.name == key else values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    return member.unionByName(dim)


def as_of(facts: DataFrame, versions: DataFrame, key: str, on_date: str, version_key: str | None = None, how: str = "inner") -> DataFrame:
    """Each fact with the version valid on its date. The range is a residual of the equi-join, so no pair outside it is made."""
    v = versions.withColumnRenamed(version_key or key, "_key").withColumnsRenamed({"valid_from": "_from", "valid_to": "_to"})
    return facts.join(v, (facts[key] == F.col("_key")) & facts[on_date].between(F.col("_from"), F.col("_to")), how).drop("_key", "_from", "_to")


def as_of_or_earliest(facts: DataFrame, versions: DataFrame, key: str, on_date: str, fact_id: str) -> DataFrame:
    """Each fact with the version valid on its date, else the earliest; exactly one row a fact. Versions are reduced to one candidate for each case before they are widened."""
    v = versions.withColumnRenamed(key, "_key")
    j = facts.join(v, facts[key] == F.col("_key"), "left")
    inside = F.coalesce(F.col(on_date).between(F.col("valid_from"), F.col("valid_to")), F.lit(False))
    j = j.withColumn("_inside", inside)
    w = Window.partitionBy(fact_id).orderBy(F.col("_inside").desc(), F.col("valid_from").asc_nulls_last(), F.col("version").asc_nulls_last())
    return j.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").withColumnRenamed("_inside", "in_window").drop("_rank", "_key")


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """dim_date: one row a day."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("full_date"))
    return days.select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"), "full_date", F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"), F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"), F.date_format("full_date", "yyyy-MM").alias("year_month"), F.weekday("full_date").alias("day_of_week"), F.date_format("full_date", "EEEE").alias("day_name"), (F.weekday("full_date") >= 5).alias("is_weekend"),
    )


def lookup(facts: DataFrame, dim: DataFrame, on: str, take: list[str], default: dict | None = None) -> DataFrame:
    """Many-to-one left join that adds ``take``; ``default`` fills what has no member."""
    d = dim.select(F.col(on).alias("_on"), *take)
    j = facts.join(d, facts[on] == F.col("_on"), "left").drop("_on")
    for c, v in (default or {}).items():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return j


def date_bounds(columns: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row: the first and last day over all date columns together."""
    days = None
    for df, c in columns:
        own = df.agg(F.min(F.col(c).cast("date")).alias("first_day"), F.max(F.col(c).cast("date")).alias("last_day"))
        days = own if days is None else days.unionByName(own)
    return days.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def keyed(facts: DataFrame, dims: dict[str, tuple[DataFrame, str]], unknown: tuple[str, ...] = ()) -> DataFrame:
    """Adds a surrogate key from each dimension: {key: (dimension, natural key)}. Facts without a member get the unknown member's key for the keys in ``unknown``, else null."""
    for key, (dim, natural) in dims.items():
        facts = lookup(facts, dim, natural, [key], {key: UNKNOWN_KEY} if key in unknown else None)
    return facts


def fact_session(sessions: DataFrame, versions: DataFrame, services: DataFrame, providers: DataFrame, centers: DataFrame) -> DataFrame:
    """The session fact: attributed to the client's version on its date, with keys of all dimensions, status flags, and zero measures unless completed."""
    j = as_of(sessions, versions.select("client_id", "version", "client_key", "valid_from", "valid_to"), "client_id", "service_date")
    j = keyed(j, {"service_key": (services, "service_code"), "provider_key": (providers, "provider_id"), "center_key": (centers, "center_id")}, ("service_key",))
    done = F.col("status") == "completed"
    return (
        j.withColumns({"date_key": date_key(F.col("service_date")), "is_completed": done, "is_cancelled": F.col("status") == "cancelled", "is_no_show": F.col("status") == "no_show"})
        .withColumn("units_delivered", F.when(done, F.col("units")).otherwise(0.0))
        .withColumn("minutes_delivered", F.when(done, F.col("minutes")).otherwise(0.0))
    )


def fact_authorization(auths: DataFrame, versions: DataFrame, services: DataFrame, payers: DataFrame) -> DataFrame:
    """The entitlement fact: the client's version at the period's start (else the earliest), keys of all dimensions and both dates, and the days of the period."""
    j = as_of_or_earliest(auths, versions.select("client_id", "version", "client_key", "valid_from", "valid_to"), "client_id", "period_start", "auth_id")
    j = keyed(j, {"service_key": (services, "service_code"), "payer_key": (payers, "payer_id")}, ("service_key",))
    j = j.withColumns({"period_start_key": date_key(F.col("period_start")), "period_end_key": date_key(F.col("period_end"))})
    return j.withColumn("authorized_days", F.datediff("period_end", "period_start") + 1).drop("valid_from", "valid_to", "in_window")
