import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordermart.plans.calendar import calendar_dim
from ordermart.plans.star import (
    agent_dim, customer_dim, customer_segment, derive_payments, line_total, menu_item_dim, order_fact,
    order_item_fact, restaurant_dim,
)
from ordermart.schemas import SOURCES, STAR


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [
            ("C1", "  anita rao  ", " Anita@Mail.COM ", "1", " Pune ", "25-34", "Female", True, "2023-01-15"),
            ("C2", "DEV o'HARA", "dev@site.in", "2", "Delhi", "35-44", "Male", False, "2024-06-01"),
            ("C3", "lee min-ho", "lee@test.com", None, "Goa", "18-24", "Male", True, "2024-03-10"),
            ("C1", "anita rao", "Anita@Mail.COM", "1", " Pune ", "25-34", "Female", True, "2023-01-15"),
            ("C4", "old\tregular ", "R@r", "4", "Goa", "55+", "Male", False, "2021-01-01"),
        ],
        "customer_id string, full_name string, email string, phone string, city string, age_group string,"
        " gender string, is_premium boolean, registration_date string",
    )


def test_customer_dim(customers):
    found = customer_dim(customers)
    assert found.columns == STAR["dim_customer"].columns
    by_id = {r.customer_id: r for r in found.collect()}
    assert len(by_id) == found.count() == 4
    assert by_id["C1"].full_name == "Anita Rao" and by_id["C1"].email == "anita@mail.com"
    assert by_id["C1"].city == "Pune" and by_id["C1"].tenure_days == 716
    assert by_id["C2"].full_name == "Dev O'Hara" and by_id["C3"].full_name == "Lee Min-Ho"
    assert {k: r.customer_segment for k, r in by_id.items()} == {
        "C1": "Premium-Loyal", "C2": "Regular-New", "C3": "Premium-New", "C4": "Regular-Loyal"
    }


def test_segment_limit_is_inclusive(spark):
    shape = "p boolean, t int"
    unknown = spark.createDataFrame([(None, 5478), (None, None)], shape)
    assert [r[0] for r in unknown.select(customer_segment(F.col("p"), F.col("t"))).collect()] == [None, None]
    frame = spark.createDataFrame([(True, None)], shape)
    assert frame.select(customer_segment(F.col("p"), F.col("t"))).first()[0] == "Premium-New"
    frame = spark.createDataFrame([(True, 365), (True, 364), (False, 365), (False, None)], shape)
    labels = [r[0] for r in frame.select(customer_segment(F.col("p"), F.col("t"))).collect()]
    assert labels == ["Premium-Loyal", "Premium-New", "Regular-Loyal", "Regular-New"]


def test_restaurant_dim(spark):
    raw = spark.createDataFrame(
        [("R1", "  spice villa  ", " Pune", "Thai", 2.3, 120, 25, False, "2022-05-10"),
         ("R2", "ROMA HOUSE", "Delhi ", "Italian", 4.5, 890, 30, True, "2023-01-01")],
        "restaurant_id string, name string, city string, cuisine_type string, rating double, total_reviews int,"
        " avg_prep_time_min int, is_veg_only boolean, onboarded_date string",
    )
    found = restaurant_dim(raw)
    assert found.columns == STAR["dim_restaurant"].columns
    assert rows(found.select("name", "city", "rating_band")) == [
        ("Roma House", "Delhi", "Excellent"), ("Spice Villa", "Pune", "Poor")
    ]


def test_menu_item_and_agent_dims(spark):
    items = spark.createDataFrame(
        [("I1", "R1", "Soup", "Starters", 80.0, True, False, 450), ("I2", "R1", "Tikka", "Main", 350.0, True, True, 300),
         ("I3", "R2", "Pizza", "Main", 250.0, False, True, 600), ("I3", "R2", "Pizza", "Main", 250.0, False, True, 600)],
        "item_id string, restaurant_id string, item_name string, category string, price double, is_available boolean,"
        " is_veg boolean, calories int",
    )
    found = menu_item_dim(items)
    assert found.columns == STAR["dim_menu_item"].columns
    assert rows(found.select("item_id", "price_band")) == [("I1", "Budget"), ("I2", "Mid-Range"), ("I3", "Mid-Range")]
    agents = spark.createDataFrame(
        [("A1", " sam y ", "Pune", "Bike", 3.2, "2023-06-01"), ("A2", "RAM K", "Delhi", "Scooter", 4.8, "2022-01-15")],
        "agent_id string, name string, city string, vehicle string, rating double, joined_date string",
    )
    found = agent_dim(agents)
    assert found.columns == STAR["dim_delivery_agent"].columns
    assert rows(found.select("name", "performance_tier", "experience_days")) == [
        ("Ram K", "Top Performer", 1081), ("Sam Y", "Below Average", 579)
    ]


def test_calendar(spark):
    days = calendar_dim(spark, "2023-01-01", "2023-12-31")
    assert days.columns == STAR["dim_date"].columns
    assert days.count() == 365
    first = days.orderBy("date_id").first()
    assert (first.date_id, first.day_name, first.day_of_week, first.week, first.is_weekend) == (20230101, "Sunday", 6, 52, True)
    assert {r.full_date for r in days.filter("is_holiday").collect()} == {
        dt.date(2023, 1, 26), dt.date(2023, 8, 15), dt.date(2023, 10, 2), dt.date(2023, 10, 24)
    }
    assert {r.month for r in days.filter("is_peak_season").collect()} == {1, 10, 11, 12}
    assert days.filter("is_weekend").count() == 105
    assert calendar_dim(spark).count() == 731


@pytest.fixture
def order_rows(spark):
    return spark.createDataFrame(
        [
            ("O1", "C1", "R1", "A1", "2023-01-02 05:59:59", 30, Decimal("1.50"), "Delivered", 10, "Web"),
            ("O2", "C1", "R1", "A1", "2023-01-02 06:00:00", 40, Decimal("2.50"), "Cancelled", 0, "Web"),
            ("O3", "C2", "R1", "A1", "2023-01-03 23:10:00", 50, Decimal("3.50"), "delivered", 0, "Web"),
            ("O4", "C2", "R1", "A1", "2025-01-01 12:00:00", 60, Decimal("4.50"), None, 0, "Web"),
            ("O1", "C9", "R9", "A9", "2024-01-02 05:59:59", 30, Decimal("1.50"), "Refunded", 10, "Web"),
        ],
        "order_id string, customer_id string, restaurant_id string, agent_id string, order_timestamp string,"
        " delivery_time_min int, distance_km decimal(5,2), status string, discount_pct int, platform string",
    )


def test_order_fact(spark, order_rows):
    payments = spark.createDataFrame(
        [("P1", "O1", "UPI", 100.0, 10.0, 20.0, 110.0, "Success"), ("P2", "O1", "Card", 1.0, 1.0, 1.0, 1.0, "Success"),
         ("P3", "O2", "Card", 50.0, None, 20.0, 0.0, "Refunded"), ("P9", "O9", "Card", 9.0, 9.0, 9.0, 9.0, "Success")],
        "payment_id string, order_id string, method string, gross_total double, discount_amount double,"
        " delivery_fee double, net_total double, status string",
    )
    fact = order_fact(order_rows, payments, calendar_dim(spark))
    assert fact.columns == STAR["fact_orders"].columns
    assert len(fact.columns) == 20
    by_id = {r.order_id: r for r in fact.collect()}
    assert sorted(by_id) == ["O1", "O2", "O3", "O4"] and fact.count() == 4
    assert by_id["O1"].customer_id == "C1" and by_id["O1"].method == "UPI"  # first by the other columns
    assert by_id["O1"].net_total == Decimal("110.00") and by_id["O1"].date_id == 20230102
    assert by_id["O2"].discount_amount == 0 and by_id["O2"].gross_total == Decimal("50.00")
    assert by_id["O3"].net_total == 0 and by_id["O3"].method is None
    assert by_id["O4"].date_id is None
    assert [by_id[o].time_of_day for o in ("O1", "O2", "O3", "O4")] == ["Night", "Morning", "Late Night", "Lunch"]
    assert [(by_id[o].is_delivered, by_id[o].is_cancelled) for o in ("O1", "O2", "O3", "O4")] == [
        (1, 0), (0, 1), (0, 0), (0, 0)
    ]


def test_order_item_fact(spark, order_rows):
    payments = spark.createDataFrame([], SOURCES["payments"].schema)
    fact = order_fact(order_rows, payments, calendar_dim(spark))
    items = spark.createDataFrame(
        [("L1", "O1", "I1", 2, 10.0, 20.0), ("L1", "O1", "I1", 2, 10.0, 20.0), ("L2", "O8", "I1", 1, 5.0, 5.0)],
        "order_item_id string, order_id string, item_id string, quantity int, unit_price double, line_total double",
    )
    found = order_item_fact(items, fact)
    assert found.columns == STAR["fact_order_items"].columns
    assert rows(found) == [("L1", "O1", "I1", "C1", 20230102, 2, 10.0, 20.0), ("L2", "O8", "I1", None, None, 1, 5.0, 5.0)]


def test_derived_payments(spark):
    orders = spark.createDataFrame(
        [("O1", "Delivered", 15, Decimal("20.00"), "UPI"), ("O2", "Cancelled", 0, Decimal("30.00"), "Card"),
         ("O3", "Odd", 5, Decimal("40.00"), "Card"), ("O4", "Delivered", 0, Decimal("1.00"), "Card")],
        "order_id string, status string, discount_pct int, delivery_fee decimal(18,2), method string",
    )
    items = spark.createDataFrame(
        [("O1", Decimal("10.05")), ("O1", Decimal("0.05")), ("O2", Decimal("7.00")), ("O3", Decimal("0.10"))],
        "order_id string, line_total decimal(18,2)",
    )
    found = derive_payments(orders, items).select(
        "order_id", "gross_total", "discount_amount", "net_total", "status"
    )
    d = Decimal
    assert rows(found) == [
        ("O1", d("10.10"), d("1.52"), d("28.58"), "Success"),  # 15 % of 10.10 is 1.515: away from zero
        ("O2", d("7.00"), d("0.00"), d("0.00"), "Refunded"),
        ("O3", d("0.10"), d("0.01"), d("40.09"), "Success"),
    ]
    assert spark.range(1).select(line_total(F.lit(3), F.lit(Decimal("9.99")))).first()[0] == d("29.97")


def test_heavy_order_is_split_by_adaptive_skew_join(spark):
    """One order with a third of all lines: its partition of the line side is cut into several tasks."""
    lines = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("order_id"),
        (F.col("id") % 10).alias("item_id"), F.lit(1).alias("quantity"),
        F.lit(Decimal("2.00")).alias("unit_price"), F.lit(Decimal("2.00")).alias("line_total"),
    )
    owners = spark.range(0, 5000, 1, 4).select(
        F.col("id").alias("order_id"), F.lit(20230101).alias("date_id"), (F.col("id") * 2).alias("customer_id")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = order_item_fact(lines, owners)
        count = found.groupBy().agg(F.count("*"), F.count_if(F.col("customer_id") == F.col("order_id") * 2))
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
        assert count.first() == (60000, 60000)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
