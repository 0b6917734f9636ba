import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordermart.plans import forecast as fc
from ordermart.plans import group_forecast as gf
from ordermart.plans.calendar import calendar_dim

START = dt.date(2022, 1, 3)  # a Monday
RUN_AT = dt.datetime(2024, 1, 1, 2, 30)


def series_of(spark, days, level):
    data = [(START + dt.timedelta(days=i), int(level(i))) for i in range(days)]
    return spark.createDataFrame(data, "ds date, y long")


@pytest.fixture(scope="module")
def weekly(spark):
    """Busy weekends, slow growth."""
    return series_of(spark, 730, lambda i: (200 if i % 7 >= 5 else 100) * (1 + i / 2000))


def test_daily_series_leaves_empty_days_out(spark):
    orders = spark.createDataFrame(
        [("O1", 20230101, "Delivered"), ("O2", 20230101, "Delivered"), ("O3", 20230102, "Cancelled"),
         ("O4", 20230103, "Delivered"), ("O5", 20230103, "delivered"), ("O6", None, "Delivered"), ("O7", 20300101, "Delivered")],
        "order_id string, date_id int, status string")
    found = fc.daily_series(orders, calendar_dim(spark, "2023-01-01", "2023-01-05"))
    assert rows(found) == [(dt.date(2023, 1, 1), 2), (dt.date(2023, 1, 3), 1)]


def test_model_frame(spark):
    found = rows(fc.model_frame(series_of(spark, 5, lambda i: i), horizon=3), "ds")
    assert [r[0] for r in found] == [START + dt.timedelta(days=i) for i in range(8)]
    assert [r[1] for r in found] == [0, 1, 2, 3, 4, None, None, None]
    assert [r[2] for r in found] == [0, 0, 0, 0, 0, 1, 1, 0]


def test_forecast_properties(spark, weekly):
    predicted = fc.fit_and_predict(weekly, horizon=30)
    future = fc.future_only(predicted, RUN_AT).collect()
    last = START + dt.timedelta(days=729)
    assert [r.forecast_date for r in future] == [last + dt.timedelta(days=i) for i in range(1, 31)]
    assert all(0 <= r.lower_bound <= r.predicted_orders <= r.upper_bound for r in future)
    assert all(r.created_at == RUN_AT for r in future)
    weekend = [r.predicted_orders for r in future if r.forecast_date.weekday() >= 5]
    workday = [r.predicted_orders for r in future if r.forecast_date.weekday() < 5]
    assert 1.8 < (sum(weekend) / len(weekend)) / (sum(workday) / len(workday)) < 2.2
    assert 110 < sum(workday) / len(workday) < 165  # 137 continues the growth
    metrics = fc.error_metrics(fc.observed(predicted), predicted).first()
    assert metrics.n_observations == 730 and metrics.mape < 5
    listed = fc.forecast_listing(fc.future_only(predicted, RUN_AT), days=7).collect()
    assert listed == future[:7]
    again = fc.future_only(fc.fit_and_predict(weekly, horizon=30), RUN_AT).collect()
    assert again == future


def test_short_and_flat_series(spark):
    flat = fc.future_only(fc.fit_and_predict(series_of(spark, 10, lambda i: 5), horizon=7), RUN_AT).collect()
    assert len(flat) == 7 and all(r.predicted_orders == 5 for r in flat)
    zero = fc.future_only(fc.fit_and_predict(series_of(spark, 30, lambda i: 0), horizon=2), RUN_AT).collect()
    assert [r.predicted_orders for r in zero] == [0, 0]


def test_empty_series(spark):
    assert fc.fit_and_predict(series_of(spark, 0, lambda i: 0)).count() == 0


def test_error_metrics(spark):
    actual = spark.createDataFrame([(dt.date(2024, 1, 1), 10), (dt.date(2024, 1, 2), 0), (dt.date(2024, 1, 3), 20), (dt.date(2024, 1, 9), 1)],
                                   "ds date, y long")
    fitted = spark.createDataFrame([(dt.date(2024, 1, 1), 8.0), (dt.date(2024, 1, 2), 3.0), (dt.date(2024, 1, 3), 25.0), (dt.date(2024, 1, 4), None)],
                                   "ds date, yhat double")
    found = fc.error_metrics(actual, fitted).first()
    assert tuple(found) == (22.5, round(10 / 3, 2), round(math.sqrt(38 / 3), 2), 3)
    assert tuple(fc.error_metrics(actual, fitted.filter("ds > '2024-02-01'")).first()) == (None, None, None, 0)
    assert fc.error_metrics(actual.filter("y = 0"), fitted).first().mape is None


def test_latest_metrics(spark):
    one = spark.createDataFrame([(1.0, 1.0, 1.0, 5)], "mape double, mae double, rmse double, n_observations long")
    history = fc.stamped(one, RUN_AT).unionByName(fc.stamped(one.withColumn("mape", F.lit(2.0)), RUN_AT + dt.timedelta(days=1)))
    assert fc.latest_metrics(history).first().mape == 2.0


def test_rounding_is_half_to_even(spark):
    predicted = spark.createDataFrame([(START, 1, 1.0, 1.0, 1.0), (START + dt.timedelta(days=1), None, 2.5, -4.0, 3.5)],
                                      "ds date, y long, yhat double, yhat_lower double, yhat_upper double")
    assert tuple(fc.future_only(predicted, RUN_AT).first())[1:4] == (2, 0, 4)


def noisy(spark, days=800, sd=0.8):
    draw = random.Random(11)
    return series_of(spark, days, lambda i: math.exp(4 + 0.3 * math.sin(i / 58) + draw.gauss(0, sd)))


def test_fitted_orders_add_up_and_the_interval_covers(spark):
    predicted = fc.fit_and_predict(noisy(spark), horizon=60)
    seen = fc.observed(predicted)
    ratio, inside = seen.agg(
        F.sum("yhat") / F.sum("y"), F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int"))
    ).first()
    assert abs(ratio - 1) < 0.01 and 0.75 < inside < 0.85
    width = [math.log1p(r.yhat_upper) - math.log1p(r.yhat_lower) for r in predicted.filter("y is null").orderBy("ds").collect()]
    assert all(a <= b + 1e-9 for a, b in zip(width, width[1:])) and width[-1] > width[0]


def test_coefficients_are_those_of_a_ridge_solution(spark):
    series = noisy(spark, 400, 0.3)
    model = fc.Model()
    data = [(r.ds, r.y) for r in series.orderBy("ds").collect()]
    first, last = data[0][0], data[-1][0]
    wide = fc.model_frame(series, 1).filter("y is not null").select("ds", *[c.alias(f"x{i}") for i, c in enumerate(fc._features(first, last, model))]).orderBy("ds").toPandas()
    x = wide.drop(columns="ds").to_numpy(float)
    y = np.log1p(np.array([n for _, n in data], float))
    sd = x.std(axis=0)
    z = np.where(sd > 0, (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1), 0)
    gram = z.T @ z / len(y) + model.penalty / y.std() * np.eye(z.shape[1])
    logs = y.mean() + z @ np.linalg.solve(gram, z.T @ (y - y.mean()) / len(y))
    scale = (np.exp(y)).sum() / np.exp(logs).sum()
    found = [r.yhat for r in fc.observed(fc.fit_and_predict(series)).orderBy("ds").collect()]
    np.testing.assert_allclose(found, np.exp(logs) * scale - 1, rtol=1e-6)


def test_groups_are_forecast_like_single_series(spark):
    draw = random.Random(4)
    kinds = {("A", "x"): (400, 3.0, 1), ("A", None): (90, 1.0, 3), ("B", "x"): (12, 0.5, 1), ("B", "y"): (1, 2.0, 1), ("C", "z"): (30, None, 1)}
    data = [
        (*key, START + dt.timedelta(days=i * step), 5 if level is None else int(math.exp(level + draw.gauss(0, 0.4))) + 1)
        for key, (days, level, step) in kinds.items() for i in range(days)
    ]
    series = spark.createDataFrame(data, "city string, cuisine_type string, ds date, y long").repartition(5)
    predicted = gf.fit_and_predict_by(series, horizon=7)
    future = {(r.city, r.cuisine_type, r.forecast_date): r for r in gf.future_by(predicted, RUN_AT).collect()}
    metrics = {(r.city, r.cuisine_type): r for r in gf.error_metrics_by(predicted).collect()}
    assert len(future) == 7 * len(kinds) and len(metrics) == len(kinds)
    for city, cuisine in kinds:
        mine = F.col("city").eqNullSafe(city) & F.col("cuisine_type").eqNullSafe(F.lit(cuisine))
        alone = fc.fit_and_predict(series.filter(mine).select("ds", "y"), horizon=7)
        ours = predicted.filter(mine).orderBy("ds").collect()
        single = alone.orderBy("ds").collect()
        assert [(r.ds, r.y) for r in ours] == [(r.ds, r.y) for r in single]
        for column in fc.PREDICTED:
            np.testing.assert_allclose([r[column] for r in ours], [r[column] for r in single], rtol=1e-9, atol=1e-9)
        one = fc.error_metrics(fc.observed(alone), alone).first()
        assert tuple(metrics[city, cuisine])[2:] == tuple(one)
        for r in fc.future_only(alone, RUN_AT).collect():
            assert tuple(future[city, cuisine, r.forecast_date])[2:] == tuple(r)
    assert gf.fit_and_predict_by(series.limit(0)).count() == 0


def test_series_by_group_leaves_unknown_merchants_out(spark):
    orders = spark.createDataFrame(
        [("O1", "R1", 20230101, "Delivered"), ("O2", "R2", 20230101, "Delivered"), ("O3", "R3", 20230101, "Delivered"),
         ("O4", "R1", 20230102, "Cancelled"), ("O5", "R9", 20230101, "Delivered"), ("O6", "R1", None, "Delivered")],
        "order_id string, restaurant_id string, date_id int, status string")
    shops = spark.createDataFrame([("R1", "A", "x"), ("R2", "A", "x"), ("R3", "B", None)], "restaurant_id string, city string, cuisine_type string")
    found = gf.daily_series_by(orders, calendar_dim(spark, "2023-01-01", "2023-01-05"), shops)
    assert rows(found) == [("A", "x", dt.date(2023, 1, 1), 2), ("B", None, dt.date(2023, 1, 1), 1)]
