import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ordermart.functions import exact, text
from ordermart.functions.bands import Bands, band, labelled
from ordermart.functions.dates import as_date, date_key, days_until, is_weekend
from ordermart.plans.star import AGENT_TIERS, PRICE_BANDS, RATING_BANDS, TIME_OF_DAY


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "value", ["  rajesh kumar  ", "PRIYA SHARMA", "o'neil de-souza", "\t\nanna  maria\x1f", "élodie ÅSE 3rd", "", "a1b2", "　x y\xa0"]
)
def test_title_case_equals_python(spark, value):
    assert one(spark, text.clean_name(F.lit(value))) == value.strip().title()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abZ '-\t\n\x1c.é9", max_size=12), min_size=40, max_size=60))
def test_cleaning_of_random_text(spark, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = frame.select("i", text.clean_name(F.col("v")), text.clean_email(F.col("v")))
    assert rows(found, "i") == [(i, v.strip().title(), v.lower().strip()) for i, v in enumerate(values)]


def test_null_text_stays_null(spark):
    null = F.lit(None).cast("string")
    assert one(spark, text.clean_name(null)) is None
    assert one(spark, text.clean_email(null)) is None


def test_same_text_and_label(spark):
    assert one(spark, text.same_text(F.lit("DELIVERED"), "Delivered")) is True
    assert one(spark, text.same_text(F.lit(None).cast("string"), "Delivered")) is None
    assert one(spark, text.month_label(F.lit(2024), F.lit(3))) == "2024-03"


@pytest.mark.parametrize(
    "bands, value, label",
    [
        (RATING_BANDS, "0", None), (RATING_BANDS, "0.1", "Poor"), (RATING_BANDS, "2.5", "Poor"),
        (RATING_BANDS, "2.6", "Average"), (RATING_BANDS, "4.2", "Good"), (RATING_BANDS, "4.3", "Excellent"),
        (RATING_BANDS, "5.0", "Excellent"), (RATING_BANDS, "5.1", None), (RATING_BANDS, None, None),
        (PRICE_BANDS, "80", "Budget"), (PRICE_BANDS, "100", "Budget"), (PRICE_BANDS, "350", "Mid-Range"),
        (PRICE_BANDS, "350.01", "Premium"), (PRICE_BANDS, "99999", "Premium"), (PRICE_BANDS, "-1", None),
        (AGENT_TIERS, "3.5", "Below Average"), (AGENT_TIERS, "4.7", "Good"), (AGENT_TIERS, "4.8", "Top Performer"),
        (TIME_OF_DAY, "0", "Night"), (TIME_OF_DAY, "5", "Night"), (TIME_OF_DAY, "6", "Morning"),
        (TIME_OF_DAY, "11", "Lunch"), (TIME_OF_DAY, "23", "Late Night"), (TIME_OF_DAY, "24", None),
    ],
)
def test_bands(spark, bands, value, label):
    for kind in ("decimal(10,2)", "double"):
        assert one(spark, band(F.lit(value).cast(kind), bands)) == label


def test_bands_reject_bad_edges():
    with pytest.raises(ValueError):
        Bands((0, 1), ("a", "b"))
    with pytest.raises(ValueError):
        Bands((0, 2, 1), ("a", "b"))


def test_first_label_wins_and_null_does_not_hold(spark):
    rules = [(F.lit(None).cast("boolean"), "null"), (F.lit(True), "first"), (F.lit(True), "second")]
    assert one(spark, labelled(rules)) == "first"
    assert one(spark, labelled(rules[:1], default="rest")) == "rest"


def test_dates(spark):
    sunday = F.lit("2023-01-01").cast("date")
    assert one(spark, date_key(sunday)) == 20230101
    assert one(spark, is_weekend(sunday)) is True
    assert one(spark, days_until("2024-12-31", F.lit("2022-03-10").cast("date"))) == 1027
    assert one(spark, as_date("2024-02-29")) == dt.date(2024, 2, 29)
    with pytest.raises(PySparkException):
        one(spark, as_date(F.lit("no date")))


@pytest.mark.parametrize(
    "numerator, denominator, decimals, expected",
    [(1, 2, 0, "1"), (-1, 2, 0, "-1"), (-3, 2, 0, "-2"), (1, 3, 2, "0.33"), (2, 3, 2, "0.67"), (1, 8, 2, "0.13"),
     (-1, 8, 2, "-0.13"), (5, 0, 2, None), (9 * 10**18, 7, 2, "1285714285714285714.29")],
)
def test_rounded_ratio(spark, numerator, denominator, decimals, expected):
    found = one(spark, exact.rounded_ratio(F.lit(numerator).cast("bigint"), F.lit(denominator).cast("bigint"), decimals))
    assert found == (None if expected is None else Decimal(expected))


def test_money_and_growth(spark):
    frame = spark.createDataFrame([(Decimal("19.99"),), (Decimal("0.01"),), (None,)], "m decimal(10,2)")
    assert frame.select(exact.money(F.sum(exact.cents("m")))).first()[0] == Decimal("20.00")
    number = lambda v: F.lit(v).cast("bigint")
    assert one(spark, exact.growth_pct(number(110), number(100))) == Decimal("10")
    assert one(spark, exact.growth_pct(number(50), number(-100))) == Decimal("-150")
    assert one(spark, exact.growth_pct(number(5), number(0))) is None
