"""Comparing, fingerprinting and merging versions of a table."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined(before: DataFrame, after: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    shared = [c for c in before.columns if c in after.columns and c not in keys]
    b, a = before.withColumn("_in", F.lit(True)).alias("b"), after.withColumn("_in", F.lit(True)).alias("a")
    on = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys])
    return b.join(a, on, "full_outer"), shared


def differs(before: DataFrame, after: DataFrame, c: str) -> Column:
    """Null equals null; two numbers compare as doubles, everything else as text."""
    numeric = all(t.schema[c].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or t.schema[c].dataType.typeName().startswith("decimal") for t in (before, after))
    kind = "double" if numeric else "string"
    return ~F.col(f"b.{c}").cast(kind).eqNullSafe(F.col(f"a.{c}").cast(kind))


def diff_summary(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """One row: added, removed, changed and unchanged rows, and changed cells by shared column (changed_<column>). Keys must be unique."""
    missing = [k for k in keys if k not in before.columns or k not in after.columns]
    if missing:
        raise ValueError(f"no key column {', '.join(missing)}")
    j, shared = joined(before, after, keys)
    both = F.col("b._in").isNotNull() & F.col("a._in").isNotNull()
    cells = {c: both & differs(before, after, c) for c in shared}
    any_cell = reduce(lambda x, y: x | y, cells.values(), F.lit(False))
    return j.agg(
        F.count_if(F.col("b._in").isNull()).alias("added"), F.count_if(F.col("a._in").isNull()).alias("removed"), F.count_if(any_cell).alias("changed"), F.count_if(both & ~any_cell).alias("unchanged"),
        *[F.count_if(x).alias(f"changed_{c}") for c, x in cells.items()],
    )


def diff_cells(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """column, changed: changed cells by column."""
    one = diff_summary(before, after, keys)
    cols = [c for c in one.columns if c.startswith("changed_")]
    return one.select(F.explode(F.array(*[F.struct(F.lit(c.removeprefix("changed_")).alias("column"), F.col(c).alias("changed")) for c in cols])).alias("x")).select("x.*")


def fingerprint(df: DataFrame) -> DataFrame:
    """rows and a checksum that does not depend on their order; equal tables have equal ones."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))


def window_from(mark: date | None, lookback: int) -> date | None:
    return mark - timedelta(days=lookback) if mark else None


def select_window(rows: DataFrame, column: str, mark: date | None, lookback: int) -> DataFrame:
    """Rows from the mark less the lookback on; everything on a first run."""
    start = window_from(mark, lookback)
    return rows if start is None else rows.where(F.col(column) >= F.lit(start))


def next_mark(rows: DataFrame, column: str, mark: date | None) -> date | None:
    """The mark never goes back and stays where there are no rows."""
    top = rows.agg(F.max(F.col(column).cast("date"))).first()[0]
    return max((x for x in (mark, top) if x), default=None)


def merged(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The target with rows of the batch's keys replaced by the batch's."""
    return target.join(batch.select(*keys).distinct(), keys, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))


def definitions_changed(before: str | None, after: str | None) -> bool:
    """Whether the rules moved between two runs, by their fingerprints."""
    return bool(before and after and before != after)


def diff_report(tables: dict[str, dict] | None, rules: tuple[str | None, str | None] = (None, None)) -> str:
    """The differences of two builds as text: rules first, then each table's rows and its most changed columns."""
    out = ["# Changes since the last published build", ""]
    if definitions_changed(*rules):
        out += [f"The rules changed: {rules[0]} before, {rules[1]} now. Figures may differ in what they mean, not only in what was delivered.", ""]
    if not tables:
        return "\n".join([*out, "There is no earlier build to compare with.", ""])
    moved = {t: d["added"] + d["removed"] + d["changed"] for t, d in tables.items()}
    out += [f"{sum(moved.values()):,} rows differ." if any(moved.values()) else "No row differs.", "", "| table | added | removed | changed | unchanged | columns |", "|---|---:|---:|---:|---:|---|"]
    for t in sorted(tables, key=lambda t: (-moved[t], t)):
        d = tables[t]
        cells = sorted(((n, c.removeprefix("changed_")) for c, n in d.items() if c.startswith("changed_") and n), key=lambda x: (-x[0], x[1]))
        out.append(f"| {t} | {d['added']} | {d['removed']} | {d['changed']} | {d['unchanged']} | {', '.join(f'{c} ({n})' for n, c in cells[:3]) or '-'} |")
    return "\n".join([*out, ""])
