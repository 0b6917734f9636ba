"""Calendar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date | Column) -> Column:
    """A literal or column as DATE; malformed text raises under ANSI mode."""
    if isinstance(value, Column):
        return F.to_date(value)
    return F.lit(str(value)).cast("date")


def as_timestamp(value: dt.datetime) -> Column:
    """A naive literal timestamp, whatever the session's time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def days_until(as_of: str | dt.date, column: Column) -> Column:
    """Whole days from ``column`` to the reference day."""
    return F.datediff(as_date(as_of), column)


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    return F.weekday(day).isin(5, 6)
