"""Scalar expressions whose meaning differs silently between engines.

Each helper pins one meaning and works on zone-less timestamps without ever
passing through the session time zone.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grains whose truncation is a whole day or coarser, and the unit `trunc` knows them by.
_DATE_UNITS = {"week": "WEEK", "month": "MM", "quarter": "QUARTER", "year": "YEAR"}

# A full calendar date, then nothing or a clock time: Spark alone also reads
# "2026" or "2026-07" as a date, which would hide a malformed value.
_FULL_DATE = r"^\s*\d+-\d{1,2}-\d{1,2}(\s*$|[T ]\d{1,2}:)"

# Java's number syntax allows a type suffix ("1.5d"), which is not a number in SQL.
_TYPE_SUFFIX = r"[0-9.][dDfF]\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- safe casts ------------------------------------------------------------


def safe_bigint(c: Column | str) -> Column:
    """Text to BIGINT; decimal text rounds half away from zero; anything else is NULL."""
    c = _col(c)
    rounded = F.round(c.try_cast("decimal(38,10)"), 0).try_cast("bigint")
    return F.coalesce(c.try_cast("bigint"), rounded)


def safe_double(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~c.rlike(_TYPE_SUFFIX), c.try_cast("double"))


def safe_timestamp(c: Column | str) -> Column:
    """ISO text to a zone-less timestamp; partial dates and garbage are NULL."""
    c = _col(c)
    return F.when(c.rlike(_FULL_DATE), c.try_cast("timestamp_ntz"))


def safe_date(c: Column | str) -> Column:
    return safe_timestamp(c).cast("date")


# ---- dates -----------------------------------------------------------------


def trunc_ntz(grain: str, c: Column | str) -> Column:
    """`date_trunc` for a DATE or TIMESTAMP that answers a zone-less timestamp."""
    c = _col(c)
    unit = grain.lower()
    if unit == "day":
        return c.cast("date").cast("timestamp_ntz")
    if unit in _DATE_UNITS:
        return F.trunc(c.cast("date"), _DATE_UNITS[unit]).cast("timestamp_ntz")
    raise ValueError(f"unsupported grain: {grain}")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Hour boundaries crossed from start to end: 10:59 -> 11:01 is 1, not 0."""
    start, end = _col(start), _col(end)
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * 24 + F.hour(end) - F.hour(start)


def days_before(c: Column | str, days: int) -> Column:
    return _col(c) - F.make_dt_interval(days=F.lit(days))


def ntz_literal(value: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal: it folds to a constant and reaches the scan."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(text).cast("timestamp_ntz")


# ---- nulls, text, numbers --------------------------------------------------


def is_not(c: Column | str, value) -> Column:
    """`c <> value OR c IS NULL`: never NULL itself."""
    return ~_col(c).eqNullSafe(F.lit(value))


def null_safe(keys, left: str, right: str) -> Column:
    """Join condition in which NULL keys match each other."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
    )


def fill(c: Column | str, sentinel="UNSPECIFIED") -> Column:
    return F.coalesce(_col(c), F.lit(sentinel))


def first_element(c: Column | str) -> Column:
    """First array element; NULL for an empty or NULL array (plain [0] raises)."""
    return F.get(_col(c), F.lit(0))


def headline(c: Column | str) -> Column:
    """Text before the first line break; stops there instead of splitting the whole text."""
    return F.substring_index(_col(c), "\n", 1)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when the whole is empty."""
    return part.cast("double") / F.greatest(whole, F.lit(1))
