"""Date expressions and the July-June fiscal year."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

__all__ = ["date_key", "key_to_date", "fiscal_year", "fiscal_month", "fiscal_quarter", "fiscal_start", "fiscal_end",
           "month_start", "day_part", "hours_booked", "days_before_event", "boundary_hours", "local_time"]

UNKNOWN_KEY = -1
MATINEE_ENDS_AT = 17
REPORT_ZONE = "America/New_York"


def date_key(value: str | Column) -> Column:
    """``yyyymmdd`` as int; NULL becomes -1, the unknown day."""
    d = as_column(value).cast("date")
    packed = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return F.coalesce(packed, F.lit(UNKNOWN_KEY)).cast("int")


def key_to_date(key: str | Column) -> Column:
    """Inverse of :func:`date_key`; keys that are not days give NULL."""
    return F.try_to_date(as_column(key).cast("string"), "yyyyMMdd")


def fiscal_year(value: str | Column) -> Column:
    """The year in which the fiscal year ends: 1 July 2025 belongs to 2026."""
    return F.year(F.add_months(as_column(value).cast("date"), 6))


def fiscal_month(value: str | Column) -> Column:
    """July is 1, June is 12."""
    return F.month(F.add_months(as_column(value).cast("date"), 6))


def fiscal_quarter(value: str | Column) -> Column:
    return F.ceil(fiscal_month(value) / F.lit(3)).cast("int")


def fiscal_start(year: Column) -> Column:
    """1 July that opens the given fiscal year."""
    return F.make_date(year - 1, F.lit(7), F.lit(1))


def fiscal_end(year: Column) -> Column:
    """30 June that closes the given fiscal year."""
    return F.make_date(year, F.lit(6), F.lit(30))


def month_start(value: str | Column) -> Column:
    return F.trunc(as_column(value).cast("date"), "month")


def day_part(value: str | Column) -> Column:
    """Matinee before 17:00, otherwise Evening (an unknown time counts as Evening)."""
    return F.when(F.hour(as_column(value)) < MATINEE_ENDS_AT, "Matinee").otherwise("Evening")


def hours_booked(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed, as hours in decimal(6,2).  Negative when the end precedes the start."""
    first = F.date_trunc("minute", as_column(start))
    last = F.date_trunc("minute", as_column(end))
    minutes = F.timestamp_diff("MINUTE", first, last)
    return (minutes.cast("decimal(12,0)") / F.lit(60)).cast("decimal(6,2)")


def days_before_event(ordered_at: str | Column, event_at: str | Column) -> Column:
    """Calendar days from order to event."""
    return F.datediff(as_column(event_at).cast("date"), as_column(ordered_at).cast("date"))


def boundary_hours(earlier: str | Column, later: str | Column) -> Column:
    """Hour boundaries between two instants: 00:59 to 01:01 is one."""
    return F.timestamp_diff("HOUR", F.date_trunc("hour", as_column(earlier)), F.date_trunc("hour", as_column(later)))


def local_time(value: str | Column, zone: str = REPORT_ZONE) -> Column:
    """A UTC instant on the wall clock of ``zone``, daylight saving included."""
    return F.from_utc_timestamp(as_column(value), zone)
