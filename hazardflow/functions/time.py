"""Time helpers. Every "now" is an ``as_of`` value, so a run can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def moment(as_of) -> Column:
    """Timestamp literal from text, a naive UTC datetime, or a Column as is."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp")


def hours_before(as_of, hours: int) -> Column:
    return moment(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")


def days_before(as_of, days: int) -> Column:
    return hours_before(as_of, 24 * int(days))


def span_hours(first: Column, last: Column) -> Column:
    """Whole-second span in hours; NULL if either end is NULL."""
    return (F.unix_timestamp(last) - F.unix_timestamp(first)) / F.lit(3600)


def date_parts(at: Column) -> dict[str, Column]:
    return {
        "year": F.year(at),
        "month": F.month(at),
        "day": F.dayofmonth(at),
        "hour": F.hour(at),
    }


def time_features(at: Column) -> dict[str, Column]:
    """Hour bucket, hour of day, and day of week with Sunday = 1."""
    return {
        "hour_window": F.date_trunc("hour", at),
        "hour_of_day": F.hour(at),
        "day_of_week": F.dayofweek(at),
    }
