"""Builders of the five dimensions and two facts.

Of several rows of a key each builder keeps the first by ``order``; the readers
add the place in the input as ``INGEST``, which makes "first" the first in the file.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions.bands import Bands, band, labelled
from ordermart.functions.dates import as_date, days_until
from ordermart.functions.exact import MONEY, cents, money
from ordermart.functions.text import clean_email, clean_name, strip
from ordermart.operators.dedup import keep_first

Order = Sequence[str] | None

# Band edges and labels, the reference day, the loyalty limit.
RATING_BANDS = Bands((0, 2.5, 3.5, 4.2, 5), ("Poor", "Average", "Good", "Excellent"))
PRICE_BANDS = Bands((0, 100, 200, 350, float("inf")), ("Budget", "Affordable", "Mid-Range", "Premium"))
AGENT_TIERS = Bands((0, 3.5, 4.2, 4.7, 5), ("Below Average", "Average", "Good", "Top Performer"))
TIME_OF_DAY = Bands(
    (0, 6, 11, 14, 17, 20, 24),
    ("Night", "Morning", "Lunch", "Afternoon", "Dinner", "Late Night"),
    right_closed=False,
)
AS_OF = "2024-12-31"
LOYAL_DAYS = 365
# Outcome of a payment by the status of its order.
PAYMENT_STATUS = {"Delivered": "Success", "Cancelled": "Refunded", "Refunded": "Refunded"}
MONEY_COLUMNS = ("gross_total", "discount_amount", "delivery_fee", "net_total")


def customer_segment(is_premium, tenure_days):
    """Premium or regular, loyal from one year of tenure on; unknown tenure is new, an unknown premium flag gives null."""
    loyal = F.coalesce(tenure_days >= LOYAL_DAYS, F.lit(False))
    return labelled(
        [
            (is_premium & loyal, "Premium-Loyal"),
            (is_premium & ~loyal, "Premium-New"),
            (~is_premium & loyal, "Regular-Loyal"),
            (~is_premium & ~loyal, "Regular-New"),
        ]
    )


def customer_dim(customers: DataFrame, as_of: str | dt.date = AS_OF, order: Order = None) -> DataFrame:
    registered = as_date(F.col("registration_date"))
    unique = keep_first(customers, "customer_id", order)
    conformed = unique.select(
        "customer_id",
        clean_name(F.col("full_name")).alias("full_name"),
        clean_email(F.col("email")).alias("email"),
        "phone",
        strip(F.col("city")).alias("city"),
        "age_group",
        "gender",
        F.col("is_premium").cast("boolean").alias("is_premium"),
        registered.alias("registration_date"),
        days_until(as_of, registered).alias("tenure_days"),
    )
    return conformed.withColumn("customer_segment", customer_segment(F.col("is_premium"), F.col("tenure_days")))


def restaurant_dim(restaurants: DataFrame, bands: Bands = RATING_BANDS, order: Order = None) -> DataFrame:
    return keep_first(restaurants, "restaurant_id", order).select(
        "restaurant_id",
        clean_name(F.col("name")).alias("name"),
        strip(F.col("city")).alias("city"),
        "cuisine_type",
        "rating",
        band(F.col("rating"), bands).alias("rating_band"),
        "total_reviews",
        "avg_prep_time_min",
        "is_veg_only",
        as_date(F.col("onboarded_date")).alias("onboarded_date"),
    )


def menu_item_dim(menu_items: DataFrame, bands: Bands = PRICE_BANDS, order: Order = None) -> DataFrame:
    return keep_first(menu_items, "item_id", order).select(
        "item_id",
        "restaurant_id",
        "item_name",
        "category",
        "price",
        band(F.col("price"), bands).alias("price_band"),
        "is_available",
        "is_veg",
        "calories",
    )


def agent_dim(
    agents: DataFrame, as_of: str | dt.date = AS_OF, bands: Bands = AGENT_TIERS, order: Order = None
) -> DataFrame:
    joined = as_date(F.col("joined_date"))
    return keep_first(agents, "agent_id", order).select(
        "agent_id",
        clean_name(F.col("name")).alias("name"),
        "city",
        "vehicle",
        "rating",
        band(F.col("rating"), bands).alias("performance_tier"),
        days_until(as_of, joined).alias("experience_days"),
        joined.alias("joined_date"),
    )


def order_fact(orders: DataFrame, payments: DataFrame, calendar: DataFrame, order: Order = None) -> DataFrame:
    """One row per order, with its payment and its calendar key.

    Both sides are unique on ``order_id`` when they meet, so the join has no
    heavy key. The calendar has one row per day, hence the broadcast; a day
    outside it leaves ``date_id`` null.
    """
    paid = keep_first(payments, "order_id", order).select("order_id", "method", *MONEY_COLUMNS)
    days = calendar.select("date_id", F.col("full_date").alias("_day"))
    placed = F.to_timestamp_ntz(F.col("order_timestamp"))
    hour = F.col("order_hour")
    joined = (
        keep_first(orders, "order_id", order)
        .withColumn("order_timestamp", placed)
        .join(paid, "order_id", "left")
        .withColumns({"_day": F.to_date("order_timestamp"), "order_hour": F.hour("order_timestamp")})
        .join(F.broadcast(days), "_day", "left")
    )

    def flag(status: str):
        return F.coalesce((F.col("status") == status).cast("int"), F.lit(0))

    amounts = [F.coalesce(F.col(c).cast(MONEY), F.lit(0).cast(MONEY)).alias(c) for c in MONEY_COLUMNS]
    return joined.select(
        "order_id", "customer_id", "restaurant_id", "agent_id", "date_id",
        "order_timestamp",
        "order_hour",
        band(hour, TIME_OF_DAY).alias("time_of_day"),
        "platform", "status",
        flag("Delivered").alias("is_delivered"),
        flag("Cancelled").alias("is_cancelled"),
        "delivery_time_min", "distance_km", "discount_pct",
        *amounts,
        "method",
    )


def order_item_fact(order_items: DataFrame, fact_orders: DataFrame, order: Order = None) -> DataFrame:
    """One row per line item, with the day and customer of its order.

    An order with very many lines makes a heavy join key on the left side only;
    adaptive skew-join splits that side and repeats its single order row.
    """
    owner = fact_orders.select("order_id", "date_id", "customer_id")
    return (
        keep_first(order_items, "order_item_id", order)
        .join(owner, "order_id", "left")
        .select(
            "order_item_id", "order_id", "item_id", "customer_id", "date_id",
            "quantity", "unit_price",
            F.col("line_total").alias("revenue"),
        )
    )


def line_total(quantity, unit_price):
    """Quantity times unit price, to the cent."""
    return F.round(quantity.cast("decimal(10,0)") * unit_price.cast(MONEY), 2).cast(MONEY)


def derive_payments(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Payments computed from the orders and their line totals.

    ``orders`` brings ``delivery_fee``, ``method`` and ``discount_pct``. Orders
    without lines have no payment; cancelled ones pay nothing. Lines are summed
    per order before the join, in each map task first.
    """
    gross = order_items.groupBy("order_id").agg(F.sum(cents("line_total")).alias("_gross"))
    amounts = (
        orders.select("order_id", "status", "discount_pct", "delivery_fee", "method")
        .join(gross, "order_id")
        .withColumn("gross_total", money("_gross"))
        .withColumn("discount_amount", F.round(F.col("gross_total") * F.col("discount_pct") / F.lit(100), 2))
        .withColumn(
            "net_total",
            F.when(F.col("status") == "Cancelled", F.lit(0)).otherwise(
                F.round(F.col("gross_total") - F.col("discount_amount") + F.col("delivery_fee"), 2)
            ),
        )
    )
    outcome = labelled(
        [(F.col("status") == status, result) for status, result in PAYMENT_STATUS.items()], default="Success"
    )
    return amounts.select(
        F.concat(F.lit("PAY"), F.col("order_id").cast("string")).alias("payment_id"),
        "order_id",
        "method",
        *[F.col(c).cast(MONEY).alias(c) for c in MONEY_COLUMNS],
        outcome.alias("status"),
    )
