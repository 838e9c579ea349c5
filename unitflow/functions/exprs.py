"""Column expressions shared by the operators. All are native: no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAR_FUTURE = "9999-12-31"
#: A plain decimal number; casts alone would also take "10d", "NaN" and "inf".
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def normalised(c: Column) -> Column:
    """Lower case without surrounding white space; null becomes empty."""
    return F.lower(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"^\s+|\s+$", ""))


def number(c: Column) -> Column:
    """A double, or null for what is no plain number."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def ratio(a: Column, b: Column) -> Column:
    """a / b; null for a zero or null divisor, as an undefined ratio is not zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def addends(c: Column) -> tuple[Column, Column]:
    """(exact, rest): a double as a decimal of 18 places, whose sums no order changes, or as it is where such a decimal cannot hold 15 digits of it."""
    exact = F.when(F.abs(c) >= 1e-3, c.try_cast("decimal(28,18)"))
    return exact, F.when(exact.isNull(), c)


def total(exact: Column, rest: Column) -> Column:
    """The sums of addends() as one double; nothing summed is 0.

    Sums of doubles differ in their last digits with the order of the rows, enough to cross a threshold that the true sum meets. Of
    the exact sum, what the addends were rounded by before (of one sign: 4e-16 of it at most) is left: a number of 15 digits so near is taken.
    """
    t = F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))
    near = F.format_string("%.14e", t).cast("double")
    return F.when((F.abs(t) < 1e15) & (F.abs(t - near) <= F.abs(t) * 4e-16), near).otherwise(t)


def at_least(c: Column, low: float) -> Column:
    """Null stays null (greatest() alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def clipped(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def days_between(end: Column, start: Column) -> Column:
    """Days of a period with both ends in it."""
    return F.datediff(end, start) + 1


def flag(c: Column) -> Column:
    """A boolean from a boolean or a 0/1 number; null is false."""
    return F.coalesce(c.cast("boolean"), F.lit(False))


def age_band(c: Column) -> Column:
    return F.when(c <= 3, "0-3").when(c <= 5, "4-5").when(c <= 8, "6-8").when(c <= 12, "9-12").when(c.isNotNull(), "13+").otherwise("unknown")


def masked(c: Column) -> Column:
    """The ends of a long value, nothing of a short one."""
    return F.when(F.length(c) > 6, F.concat(F.substring(c, 1, 2), F.lit("…"), F.right(c, F.lit(2)))).otherwise(F.lit("…"))


def finite(c: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def pseudonym(c: Column, key: bytes, prefix: str) -> Column:
    """prefix-XXXXXXXXXXXX: the first 12 hex digits of HMAC-SHA256; null becomes empty.

    The key is padded on the driver once, so that all tasks and recomputed stages agree on it.
    """
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)
    first = F.unhex(F.sha2(F.concat(F.lit(inner), c.cast("string").cast("binary")), 256))
    digest = F.sha2(F.concat(F.lit(outer), first), 256)
    return F.coalesce(F.concat(F.lit(prefix + "-"), F.upper(F.substring(digest, 1, 12))), F.lit(""))
