"""Calendar arithmetic.

Differences count the boundaries crossed between two instants, not elapsed
units, and use only date and clock fields: the result is the same for
timestamps with and without a zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440.0


def as_date(ts: Column) -> Column:
    return ts.cast("date")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(as_date(end), as_date(start))


def minutes_between(start: Column, end: Column) -> Column:
    return (
        days_between(start, end).cast("bigint") * 1440
        + (F.hour(end) - F.hour(start)) * 60
        + (F.minute(end) - F.minute(start))
    )


def seconds_between(start: Column, end: Column) -> Column:
    return minutes_between(start, end) * 60 + (F.second(end) - F.second(start))


def months_apart(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def month_start(ts: Column) -> Column:
    return F.trunc(as_date(ts), "MM")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "QUARTER")


def year_start(d: Column) -> Column:
    return F.trunc(d, "YEAR")


def date_key(ts: Column) -> Column:
    """yyyymmdd as an integer, without going through text."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def month_key(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


def iso_weekday(d: Column) -> Column:
    return F.weekday(d) + 1


def lead_days(start: Column, end: Column) -> Column:
    """Days from start to end on the minute grid; NULL if negative or open."""
    return F.when(end >= start, minutes_between(start, end) / F.lit(MINUTES_PER_DAY))


def timeline_is_valid(created: Column, shipped: Column, delivered: Column, returned: Column) -> Column:
    """1 unless a later step is dated before, or exists without, the step it needs."""
    early_ship = shipped < created
    bad_delivery = delivered.isNotNull() & (shipped.isNull() | (delivered < shipped))
    bad_return = returned.isNotNull() & (delivered.isNull() | (returned < delivered))
    broken = F.coalesce(early_ship, F.lit(False)) | bad_delivery | bad_return
    return F.when(broken, 0).otherwise(1)
