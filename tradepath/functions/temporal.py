"""Durations between timestamps, as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(end, start) -> Column:
    """Signed seconds from start to end, with microseconds kept.

    Goes through the interval type, so zone-less timestamps are never read in
    the session time zone. decimal(18,6) stays within a long inside codegen.
    """
    gap = (_col(end) - _col(start)).cast("interval second")
    return gap.cast("decimal(18,6)").cast("double")


def hours_between(end, start) -> Column:
    return seconds_between(end, start) / SECONDS_PER_HOUR


def days_between(end, start) -> Column:
    return seconds_between(end, start) / SECONDS_PER_DAY


def floor_days_between(end, start) -> Column:
    """Whole days rounded towards minus infinity: one second early is day -1."""
    return F.floor(days_between(end, start))


def month_of(ts) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(ts).cast("date"), "month")


def date_key(ts) -> Column:
    """yyyymmdd as int, null for a null timestamp."""
    t = _col(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def plus(ts, days=0, hours=0) -> Column:
    """Timestamp shifted by whole days and hours (int columns or literals)."""
    d = days if isinstance(days, Column) else F.lit(days)
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return _col(ts) + F.make_dt_interval(d.cast("int"), h.cast("int"))
