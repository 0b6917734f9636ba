"""Calendar dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions.dates import as_date, date_key, day_name, is_weekend, month_name

# Public holidays and peak months of the default calendar.
HOLIDAYS = (
    "2023-01-26", "2023-08-15", "2023-10-02", "2023-10-24",
    "2024-01-26", "2024-08-15", "2024-10-02", "2024-10-31",
)
PEAK_MONTHS = (10, 11, 12, 1)


def calendar_of(
    bounds: DataFrame, holidays: Iterable[str] = HOLIDAYS, peak_months: Iterable[int] = PEAK_MONTHS
) -> DataFrame:
    """Calendar from a one-row frame ``(first_day, last_day)``, both inclusive."""
    day = F.col("full_date")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date"))
    return days.select(
        date_key(day).alias("date_id"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week"),
        F.weekday(day).alias("day_of_week"),
        day_name(day).alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        day.isin([as_date(h) for h in holidays]).alias("is_holiday"),
        F.month(day).isin(list(peak_months)).alias("is_peak_season"),
    )


def calendar_dim(
    spark: SparkSession,
    start: str | dt.date = "2023-01-01",
    end: str | dt.date = "2024-12-31",
    holidays: Iterable[str] = HOLIDAYS,
    peak_months: Iterable[int] = PEAK_MONTHS,
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    bounds = spark.range(1).select(as_date(start).alias("first_day"), as_date(end).alias("last_day"))
    return calendar_of(bounds, holidays, peak_months)
