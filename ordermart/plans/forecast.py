"""Daily order forecast and its error measures.

The series has one row per calendar day however many orders there are: Spark
aggregates the orders, derives the features as columns and fits the model with
``pyspark.ml``. The model is additive on log(1 + orders), that is
multiplicative on orders: a trend that may bend at 25 points in the first 80 %
of the history, yearly and weekly Fourier terms and a weekend flag (the
structure published by Taylor and Letham, "Forecasting at Scale", 2018). The
weekly terms already span the weekend flag, hence the ridge penalty.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.dates import as_timestamp, is_weekend
from ordermart.session import ensure_checkpoint_dir


PREDICTED = ("yhat", "yhat_lower", "yhat_upper")


@dataclass(frozen=True)
class Model:
    """Settings of the fit."""

    changepoints: int = 25
    changepoint_range: float = 0.8
    yearly_order: int = 10
    weekly_order: int = 3
    penalty: float = 0.001
    coverage: float = 0.8  # share of the days inside the interval


def daily_series(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Delivered orders per day ``(ds, y)``; days without orders are absent."""
    counts = orders.filter(F.col("status") == "Delivered").groupBy("date_id").agg(F.count("order_id").alias("y"))
    return counts.join(calendar.select("date_id", "full_date"), "date_id").select(F.col("full_date").alias("ds"), "y")


def model_frame(series: DataFrame, horizon: int = 30) -> DataFrame:
    """History plus ``horizon`` following days (``y`` null), with the weekend flag."""
    last = series.agg(F.max("ds").alias("last"))
    future = last.select(
        F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon), F.expr("interval 1 day"))).alias("ds"),
        F.lit(None).cast("bigint").alias("y"),
    )
    return series.unionByName(future).withColumn("is_weekend", is_weekend(F.col("ds")).cast("int"))


def _features(first: dt.date, last: dt.date, model: Model) -> list[Column]:
    day = F.unix_date("ds")
    span = max((last - first).days, 1)
    t = F.datediff("ds", F.lit(first)) / F.lit(span)
    bends = [model.changepoint_range * (i + 1) / model.changepoints for i in range(model.changepoints)]
    hinges = [F.greatest(t - F.lit(bend), F.lit(0.0)) for bend in bends]
    waves = []
    for period, order in ((365.25, model.yearly_order), (7.0, model.weekly_order)):
        for k in range(1, order + 1):
            angle = day * F.lit(2.0 * math.pi * k / period)
            waves += [F.sin(angle), F.cos(angle)]
    return [t, *hinges, *waves, F.col("is_weekend").cast("double")]


def fit_and_predict(series: DataFrame, horizon: int = 30, model: Model = Model()) -> DataFrame:
    """Observed and future days ``(ds, y, yhat, yhat_lower, yhat_upper)``; ``y`` is null in the future.

    The fit is on logarithms, whose mean belongs to the median of the orders; a
    factor brings the fitted orders back to the sum of the observed ones. The
    interval is that of the residuals of the observed days. Ahead of them it
    grows as if the trend might bend as often as it could in the past: by the
    square root of 1 + days ahead * changepoints / days of history.

    Empty when the series is. The series is checkpointed, so the orders behind
    it are read once for bounds, fit and prediction.
    """
    ensure_checkpoint_dir(series.sparkSession)
    series = series.checkpoint()
    frame = model_frame(series, horizon)
    first, last = series.agg(F.min("ds"), F.max("ds")).first()
    if first is None:
        return frame.select("ds", "y", *[F.lit(None).cast("double").alias(c) for c in PREDICTED])
    columns = _features(first, last, model)
    names = [f"x{i}" for i in range(len(columns))]
    wide = frame.select("ds", "y", F.log1p("y").alias("target"), *[c.alias(n) for c, n in zip(columns, names)])
    design = VectorAssembler(inputCols=names, outputCol="x").transform(wide).select("ds", "y", "target", "x")
    regression = LinearRegression(
        featuresCol="x", labelCol="target", predictionCol="log_yhat",
        regParam=model.penalty, elasticNetParam=0.0, solver="normal",
    )
    # One row per day fits one partition; sorted there, additions have a fixed order.
    fitted = regression.fit(design.filter(F.col("y").isNotNull()).coalesce(1).sortWithinPartitions("ds"))
    placed = fitted.transform(design).select("ds", "y", "target", "log_yhat")
    tail = (1 - model.coverage) / 2
    residual = F.col("target") - F.col("log_yhat")
    scale, low, high = placed.filter(F.col("y").isNotNull()).agg(
        F.sum(F.col("y") + 1) / F.sum(F.exp("log_yhat")), F.percentile(residual, F.lit(tail)),
        F.percentile(residual, F.lit(1 - tail)),
    ).first()
    ahead = F.greatest(F.datediff("ds", F.lit(last)), F.lit(0))
    widening = F.sqrt(1 + ahead * F.lit(model.changepoints / max((last - first).days, 1)))
    middle = F.exp("log_yhat") * F.lit(scale) - 1
    edges = [F.expm1(F.col("log_yhat") + widening * F.lit(edge)) for edge in (low, high)]
    return placed.select(
        "ds", "y", middle.alias("yhat"),
        F.least(edges[0], middle).alias("yhat_lower"), F.greatest(edges[1], middle).alias("yhat_upper"),
    )


def future_only(predicted: DataFrame, created_at: dt.datetime) -> DataFrame:
    """Days after the last observed one, clipped at zero and rounded half to even."""
    last = observed(predicted).agg(F.max("ds")).scalar()

    def whole(column: str) -> Column:
        return F.bround(F.greatest(F.col(column), F.lit(0.0)), 0).cast("bigint")

    return (
        predicted.filter(F.col("ds") > last)
        .select(
            F.col("ds").alias("forecast_date"),
            whole("yhat").alias("predicted_orders"),
            whole("yhat_lower").alias("lower_bound"),
            whole("yhat_upper").alias("upper_bound"),
            as_timestamp(created_at).alias("created_at"),
        )
        .orderBy("forecast_date")
    )


def observed(predicted: DataFrame) -> DataFrame:
    """The days of the series itself."""
    return predicted.filter(F.col("y").isNotNull())


def forecast_listing(forecast: DataFrame, days: int | None = None) -> DataFrame:
    """The forecast by day; the first ``days`` of it for a preview."""
    ordered = forecast.orderBy("forecast_date")
    return ordered if days is None else ordered.limit(days)


def error_metrics(actual: DataFrame, fitted: DataFrame) -> DataFrame:
    """MAPE over days with orders, MAE, RMSE and the number of days both sides have; one row."""
    both = actual.select("ds", "y").join(fitted.select("ds", "yhat").dropna(), "ds")
    error = F.col("y") - F.col("yhat")
    relative = F.when(F.col("y") > 0, F.abs(error / F.col("y")))
    return both.agg(
        F.round(F.avg(relative) * 100, 2).alias("mape"),
        F.round(F.avg(F.abs(error)), 2).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        F.count(F.lit(1)).alias("n_observations"),
    )


def stamped(metrics: DataFrame, evaluated_at: dt.datetime) -> DataFrame:
    return metrics.select(
        as_timestamp(evaluated_at).alias("evaluated_at"), "mape", "mae", "rmse", "n_observations"
    )


def latest_metrics(history: DataFrame) -> DataFrame:
    return history.orderBy(F.col("evaluated_at").desc_nulls_last()).limit(1)
