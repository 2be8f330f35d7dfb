"""Date helpers whose meaning differs from the Spark function of the same name."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    31 Dec 23:59 to 1 Jan 00:01 is one year, one month, one day, one hour and two
    minutes apart.  Spark's timestampdiff counts whole elapsed units instead.  Only
    calendar fields are used, so the time zone has no part in it.
    """
    if unit == "year":
        return F.year(end) - F.year(start)
    if unit == "month":
        return boundary_diff("year", start, end) * 12 + F.month(end) - F.month(start)
    days = F.datediff(F.to_date(end), F.to_date(start))
    if unit == "day":
        return days
    hours = days.cast("bigint") * 24 + F.hour(end) - F.hour(start)
    if unit == "hour":
        return hours
    if unit == "minute":
        return hours * 60 + F.minute(end) - F.minute(start)
    raise ValueError(f"unknown unit: {unit}")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods between two zone-free times."""
    return F.extract(F.lit("DAY"), end - start)


def day_of_week(when: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(when) - 1


def month_start(when: Column) -> Column:
    return F.trunc(F.to_date(when), "month").cast("timestamp_ntz")


def week_start(when: Column) -> Column:
    """Midnight of the Monday on or before ``when``."""
    return F.trunc(F.to_date(when), "week").cast("timestamp_ntz")


def iso_text(when: Column) -> Column:
    """ISO 8601 to the second.  Formatting by pattern would read the time in the session zone."""
    return F.replace(F.substring(when.cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def midnight(day: date) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def moment(at: datetime) -> Column:
    """A Python time as a zone-free literal; a plain literal would shift with the session zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
