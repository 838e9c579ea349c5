"""Deterministic views that give the test tables the roles of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The service catalogue.
CATALOGUE = (("view", "Viewing", "front", 45), ("click", "Clicking", "front", 30), ("purchase", "Purchase", "back", 15), ("signup", "Sign-up", "back", 15), ("error", "Error", "ops", 15))
AS_OF = "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows as literals: the planner knows their size, unlike that of rows sent from Python, and so can broadcast them."""
    names = [c.split() for c in schema.split(", ")]
    made = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(r, names, strict=True)]) for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*made)))


def catalogue(spark: SparkSession, without: tuple[str, ...] = ()) -> DataFrame:
    rows = [r for r in CATALOGUE if r[0] not in without]
    return literal_rows(spark, rows, "service_code string, service_name string, discipline string, minutes_per_unit int")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    day, n = F.to_date("ts"), F.col("event_id") % 25
    return e.select(
        F.col("event_id").alias("session_id"), F.col("user_id").alias("client_id"), F.col("event_type").alias("service_code"), day.alias("service_date"),
        F.when(F.col("event_id") % 17 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("duration_value"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None)).when(F.col("event_id") % 19 == 0, " Hours ").when(day < "2024-01-16", "minutes").otherwise(" Units").alias("duration_uom"),
        F.when(n == 0, "no_show").when(n <= 2, "cancelled").otherwise("completed").alias("status"),
        (F.col("user_id") % 5).alias("center_id"), (F.col("event_id") % 85).alias("provider_id"),
    )


def authorizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "events").select(F.col("user_id").alias("client_id"), F.col("event_type").alias("service_code")).distinct()
    k = pairs.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    return k.select(
        F.concat_ws("-", F.col("client_id").cast("string"), "service_code", F.col("k").cast("string")).alias("auth_id"), "client_id", "service_code",
        (4 + F.col("client_id") % 5).cast("double").alias("units_authorized"),
        F.date_add(F.lit("2024-01-01").cast("date"), 13 * F.col("k")).alias("period_start"), F.date_add(F.lit("2024-01-13").cast("date"), 13 * F.col("k")).alias("period_end"),
        F.when(F.col("client_id") % 7 != 0, F.col("client_id") % 5).alias("center_id"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("client_id"), F.to_date("o_orderdate").alias("effective_date"), F.col("o_orderpriority").alias("payer_id"), "o_orderkey")


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their customer and ship date: the facts of the as-of joins."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("client_id"), F.to_date("l_shipdate").alias("service_date"), "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
