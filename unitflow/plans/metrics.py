"""The metric registry: each metric has a sentence, a Spark SQL expression over its grain's view and a DataFrame form; parity compares them."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOLERANCE = 1e-6


@dataclass(frozen=True)
class Metric:
    key: str
    sentence: str
    grain: str
    sql: str
    column: Callable[[], Column]


def _share() -> Column:
    return F.try_divide(F.sum("units_delivered"), F.sum("units_authorized"))


DELIVERED = "status = 'completed' AND uom_resolved"
#: ``sessions`` is the resolved sessions, ``utilization`` the roll-up.
METRICS = (
    Metric("units_authorized", "Units that payers authorised.", "utilization", "SUM(units_authorized)", lambda: F.sum("units_authorized")),
    Metric("units_delivered_completed", "Units of completed sessions.", "sessions", "SUM(units) FILTER (WHERE status = 'completed')", lambda: F.sum(F.when(F.expr("status = 'completed'"), F.col("units")))),
    Metric("hours_delivered", "Hours of completed, resolved sessions.", "sessions", f"SUM(minutes) FILTER (WHERE {DELIVERED}) / 60", lambda: F.sum(F.when(F.expr(DELIVERED), F.col("minutes"))) / 60),
    Metric("session_count", "Sessions.", "sessions", "COUNT(DISTINCT session_id)", lambda: F.countDistinct("session_id")),
    Metric("authorization_count", "Authorisations.", "utilization", "COUNT(DISTINCT auth_id)", lambda: F.countDistinct("auth_id")),
    Metric("children_served", "People with a session.", "sessions", "COUNT(DISTINCT client_id)", lambda: F.countDistinct("client_id")),
    Metric("auth_units_delivered", "Units delivered within an authorised period.", "utilization", "SUM(units_delivered)", lambda: F.sum("units_delivered")),
    Metric("units_unused", "Authorised units not delivered, never below zero for an authorisation.", "utilization", "SUM(GREATEST(units_authorized - units_delivered, 0))", lambda: F.sum("units_unused")),
    Metric("hours_unused", "The same in hours.", "utilization", "SUM(hours_unused)", lambda: F.sum("hours_unused")),
    Metric("hours_authorized", "Authorised hours.", "utilization", "SUM(hours_authorized)", lambda: F.sum("hours_authorized")),
    Metric("authorization_utilization", "Delivered share of authorised units.", "utilization", "TRY_DIVIDE(SUM(units_delivered), SUM(units_authorized))", _share),
)


def frame_values(frames: dict[str, DataFrame]) -> DataFrame:
    """metric, value: one pass over each grain's table."""
    out = None
    for grain in dict.fromkeys(m.grain for m in METRICS):
        own = [m for m in METRICS if m.grain == grain]
        one = frames[grain].agg(*[m.column().cast("double").alias(m.key) for m in own])
        rows = one.select(F.explode(F.array(*[F.struct(F.lit(m.key).alias("metric"), F.col(m.key).alias("value")) for m in own])).alias("x")).select("x.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def sql_values(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """metric, value: the SQL forms, one aggregate over each grain's view."""
    parts = []
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
        own = [m for m in METRICS if m.grain == name]
        pairs = ", ".join(f"'{m.key}', {m.key}" for m in own)
        parts.append(f"SELECT stack({len(own)}, {pairs}) AS (metric, value) FROM (SELECT {', '.join(f'CAST({m.sql} AS DOUBLE) AS {m.key}' for m in own)} FROM {name})")
    return spark.sql(" UNION ALL ".join(parts))


def parity(frames: dict[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """metric, sql_value, frame_value, agrees: both forms of every metric in one aggregate over each grain's table."""
    out = None
    for grain in dict.fromkeys(m.grain for m in METRICS):
        own = [m for m in METRICS if m.grain == grain]
        one = frames[grain].agg(*[F.struct(F.lit(m.key).alias("metric"), F.expr(m.sql).cast("double").alias("sql_value"), m.column().cast("double").alias("frame_value")).alias(m.key) for m in own])
        rows = one.select(F.explode(F.array(*[F.col(m.key) for m in own])).alias("x")).select("x.*")
        out = rows if out is None else out.unionByName(rows)
    agrees = F.coalesce(F.abs(F.col("sql_value") - F.col("frame_value")) <= tolerance, F.col("sql_value").isNull() & F.col("frame_value").isNull())
    return out.withColumn("agrees", agrees)


def catalogue_markdown() -> str:
    return "\n".join(["| metric | definition |", "|---|---|", *(f"| {m.key} | {m.sentence} |" for m in METRICS)])


def measures(text: str) -> dict[str, str]:
    """Measures of a report's text: ``Name =`` at the beginning of a line, and the lines up to the next blank one. Comments (//) are left out."""
    out: dict[str, str] = {}
    name = None
    for line in text.splitlines():
        line = line.split("//")[0].rstrip()
        head = re.fullmatch(r"(\w[^=\[\]]*?)\s*=", line)
        if head:
            name = head.group(1)
            out[name] = ""
        elif not line.strip():
            name = name if name and not out[name] else None
        elif name:
            out[name] += line.strip() + "\n"
    return out


def contract(text: str, wanted: dict[str, tuple[str, ...]]) -> dict[str, list[str] | None]:
    """Of each wanted measure the columns that it does not mention, itself or in a measure that it refers to by [name]; None: no such measure."""
    have = measures(text)

    def missing(name: str) -> list[str] | None:
        if name not in have:
            return None
        body = have[name] + "".join(have.get(ref, "") for ref in re.findall(r"\[([^\]]+)\]", have[name]))
        return [c for c in wanted[name] if not re.search(rf"(?<!\w){re.escape(c)}(?!\w)", body)]

    return {name: missing(name) for name in wanted}


def catalogue_json() -> str:
    return json.dumps([{"key": m.key, "sentence": m.sentence, "grain": m.grain, "sql": m.sql} for m in METRICS])
