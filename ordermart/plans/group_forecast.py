"""Daily order forecasts of many series at once, one for each group of orders.

Every group is fitted like the single series of ``forecast``: the same features, the
same ridge regression on log(1 + orders), scale, interval and horizon, each from the
days of its own orders. A group has one row for each of its days, however many orders
it holds, so all that a task keeps is a calendar's worth of rows; groups are fitted
side by side and nothing is collected. The normal equations are the sum of the outer
products of the rows of a group, solved once for each.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.dates import as_timestamp
from ordermart.plans.forecast import PREDICTED, Model

#: Groups of the forecasts that the daily job writes.
GROUPS = ("city", "cuisine_type")


def daily_series_by(orders: DataFrame, calendar: DataFrame, restaurants: DataFrame, keys: Sequence[str] = GROUPS) -> DataFrame:
    """Delivered orders per group and day ``(*keys, ds, y)``; days without orders are absent.

    ``keys`` are columns of ``restaurants``. Orders are counted by merchant and day before
    merchants are joined, so a merchant with very many orders meets the join as one row a
    day. Orders of an unknown merchant, or outside the calendar, are left out.
    """
    counts = (
        orders.filter(F.col("status") == "Delivered").groupBy("restaurant_id", "date_id")
        .agg(F.count("order_id").alias("y"))
    )
    return (
        counts.join(restaurants.select("restaurant_id", *keys), "restaurant_id")
        .groupBy(*keys, "date_id").agg(F.sum("y").alias("y"))
        .join(calendar.select("date_id", "full_date"), "date_id")
        .select(*keys, F.col("full_date").alias("ds"), "y")
    )


def _design(day: np.ndarray, first: int, last: int, model: Model) -> np.ndarray:
    """Features of days since 1970-01-01: trend, bends, yearly and weekly waves, weekend."""
    t = (day - first) / max(last - first, 1)
    columns = [t]
    columns += [np.maximum(t - model.changepoint_range * (i + 1) / model.changepoints, 0.0) for i in range(model.changepoints)]
    for period, order in ((365.25, model.yearly_order), (7.0, model.weekly_order)):
        for k in range(1, order + 1):
            angle = day * (2.0 * math.pi * k / period)
            columns += [np.sin(angle), np.cos(angle)]
    columns.append(((day + 3) % 7 >= 5).astype(float))  # day 0 was a Thursday
    return np.column_stack(columns)


def fit_series(day: np.ndarray, y: np.ndarray, horizon: int, model: Model) -> pd.DataFrame:
    """Observed and ``horizon`` following days with prediction and interval; ``y`` is null in the future."""
    order = np.argsort(day, kind="stable")
    day, y = day[order], y[order].astype(float)
    first, last = int(day[0]), int(day[-1])
    days = np.r_[day, np.arange(last + 1, last + horizon + 1)]
    x, target = _design(days.astype(float), first, last, model), np.log1p(y)
    seen = x[:len(day)]
    mean, sd, level, spread = seen.mean(axis=0), seen.std(axis=0), target.mean(), target.std()
    used = sd > 0
    z = np.where(used, (x - mean) / np.where(used, sd, 1.0), 0.0)
    logs = np.full(len(days), level)
    if spread > 0:  # a constant series is its own forecast
        own = z[:len(day)]
        normal = own.T @ own / len(day) + model.penalty / spread * np.eye(z.shape[1])
        logs = level + z @ np.linalg.solve(normal, own.T @ (target - level) / len(day))
    residual = target - logs[:len(day)]
    tail = (1 - model.coverage) / 2
    scale = (y + 1).sum() / np.exp(logs[:len(day)]).sum()
    low, high = np.quantile(residual, [tail, 1 - tail])
    width = np.sqrt(1 + np.maximum(days - last, 0) * (model.changepoints / max(last - first, 1)))
    middle = np.exp(logs) * scale - 1
    return pd.DataFrame({
        "day": days, "y": pd.array([*y.astype(np.int64), *[None] * horizon], dtype="Int64"), "yhat": middle,
        "yhat_lower": np.minimum(np.expm1(logs + width * low), middle),
        "yhat_upper": np.maximum(np.expm1(logs + width * high), middle),
    })


def fit_and_predict_by(
    series: DataFrame, keys: Sequence[str] = GROUPS, horizon: int = 30, model: Model = Model()
) -> DataFrame:
    """``(*keys, ds, y, yhat, yhat_lower, yhat_upper)``: observed and following days of every group.

    Each group goes on from its own last day. Null keys are a group like any other.
    Empty when the series is.
    """
    kinds = ", ".join(f"`{k}` {series.schema[k].dataType.simpleString()}" for k in keys)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        found = fit_series(group["day"].to_numpy(np.int64), group["y"].to_numpy(np.int64), horizon, model)
        for k in keys:
            value = group[k].iloc[0]
            found[k] = pd.Series([None if pd.isna(value) else value] * len(found), dtype=object)
        return found

    schema = f"{kinds}, day int, y bigint, yhat double, yhat_lower double, yhat_upper double"
    fitted = series.select(*keys, F.unix_date("ds").alias("day"), "y").groupBy(*keys).applyInPandas(fit, schema)
    return fitted.select(*keys, F.date_from_unix_date("day").alias("ds"), "y", *PREDICTED)


def future_by(predicted: DataFrame, created_at: dt.datetime, keys: Sequence[str] = GROUPS) -> DataFrame:
    """The days ahead of each group, clipped at zero and rounded half to even."""

    def whole(column: str) -> Column:
        return F.bround(F.greatest(F.col(column), F.lit(0.0)), 0).cast("bigint")

    return predicted.filter(F.col("y").isNull()).select(
        *keys, F.col("ds").alias("forecast_date"), whole("yhat").alias("predicted_orders"),
        whole("yhat_lower").alias("lower_bound"), whole("yhat_upper").alias("upper_bound"),
        as_timestamp(created_at).alias("created_at"),
    )


def error_metrics_by(predicted: DataFrame, keys: Sequence[str] = GROUPS) -> DataFrame:
    """MAPE over days with orders, MAE, RMSE and the number of observed days of every group."""
    error = F.col("y") - F.col("yhat")
    return predicted.filter(F.col("y").isNotNull()).groupBy(*keys).agg(
        F.round(F.avg(F.when(F.col("y") > 0, F.abs(error / F.col("y")))) * 100, 2).alias("mape"),
        F.round(F.avg(F.abs(error)), 2).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        F.count(F.lit(1)).alias("n_observations"),
    )
