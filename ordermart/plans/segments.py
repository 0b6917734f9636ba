"""Lifetime value tiers and recency / frequency / monetary segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.bands import labelled
from ordermart.functions.dates import days_until
from ordermart.functions.exact import cents, mean_money, mean_tenths, money
from ordermart.functions.text import same_text
from ordermart.operators.ranking import first_with_ntile, ntile_scores

# Tier names by quartile.
CLV_TIERS = ("Champion", "Loyal", "At-Risk", "Dormant")

def _buyers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered totals per known customer, one narrow row each.

    Orders are summed per customer before the join, so a customer with very
    many orders is one row on either side. Names join later, after ranking.
    """
    totals = (
        orders.filter(same_text(F.col("status"), "delivered"))
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(cents("net_total")).alias("net_cents"),
            F.count("net_total").alias("priced"),
            F.to_date(F.max("order_timestamp")).alias("last_day"),
        )
    )
    return totals.join(customers.select("customer_id"), "customer_id", "left_semi")


def _named(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "full_name", "city", "customer_segment")


def _clv_columns() -> list:
    return [
        "customer_id", "full_name", "city", "customer_segment",
        F.col("n_orders").alias("total_orders"),
        money("net_cents").alias("lifetime_value"),
        mean_money(F.col("net_cents"), F.col("priced")).alias("avg_order_value"),
    ]


def customer_lifetime_value(
    customers: DataFrame, orders: DataFrame, as_of: str | dt.date, limit: int = 50
) -> DataFrame:
    """Customers by lifetime value with quartile and tier; those without a delivered order are left out."""
    by_value = [F.col("net_cents").desc_nulls_first(), F.col("customer_id").asc()]
    best = first_with_ntile(_buyers(customers, orders), len(CLV_TIERS), by_value, "clv_quartile", limit)
    return (
        _named(customers).join(best, "customer_id")
        .orderBy(*by_value)
        .select(
            *_clv_columns(),
            F.col("last_day").alias("last_order_date"),
            days_until(as_of, F.col("last_day")).alias("days_since_last_order"),
            "clv_quartile",
            labelled([(F.col("clv_quartile") == i, tier) for i, tier in enumerate(CLV_TIERS, 1)]).alias("clv_tier"),
        )
    )


def clv_top(customers: DataFrame, orders: DataFrame, limit: int = 20) -> DataFrame:
    """Best customers by lifetime value, without tiers."""
    by_value = [F.col("net_cents").desc_nulls_last(), F.col("customer_id").asc()]
    best = _buyers(customers, orders).orderBy(*by_value).limit(limit)
    return _named(customers).join(best, "customer_id").orderBy(*by_value).select(*_clv_columns())


def _scored(customers: DataFrame, orders: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Quintile scores: recent, frequent and high-spending customers score high."""
    recency = days_until(as_of, F.col("last_day"))
    scored = ntile_scores(
        _buyers(customers, orders),
        "customer_id",
        {"r_score": -recency, "f_score": F.col("n_orders"), "m_score": F.col("net_cents")},
        tiles=5,
    )
    return scored.select(
        "customer_id",
        (-F.col("r_score_value")).cast("int").alias("recency_days"),
        F.col("f_score_value").alias("n_orders"),
        F.col("m_score_value").alias("net_cents"),
        "r_score", "f_score", "m_score",
    )


def _rfm_label() -> Column:
    """Segment of the three scores; the first condition that holds wins."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    # The thresholds and the names of the segments.
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2) & (m <= 2), "New Customers")
        .when((r >= 3) & (f >= 3) & (m >= 2), "Potential Loyalists")
        .when((r >= 4) & (f >= 4) & (m <= 2), "Recent Customers")
        .when((r <= 2) & (f >= 4) & (m >= 4), "At-Risk Customers")
        .when((r <= 2) & (f >= 3) & (m >= 3), "About to Sleep")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
        .when((r >= 3) & (f <= 2) & (m >= 3), "Can't Lose Them")
        .otherwise("Others")
    )


def _segmented(customers: DataFrame, orders: DataFrame, as_of: str | dt.date) -> DataFrame:
    return _scored(customers, orders, as_of).withColumns(
        {"rfm_total": F.expr("r_score + f_score + m_score"), "rfm_segment": _rfm_label()}
    )


def rfm_customers(customers: DataFrame, orders: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Scores and segment of every customer with a delivered order."""
    return _segmented(customers, orders, as_of).join(_named(customers), "customer_id").select(
        "customer_id", "full_name", "city", "customer_segment",
        F.col("n_orders").alias("frequency"),
        money("net_cents").alias("monetary"),
        "recency_days",
        mean_money(F.col("net_cents"), F.col("n_orders")).alias("avg_order_value"),
        "r_score", "f_score", "m_score", "rfm_total", "rfm_segment",
    )


def rfm_segments(customers: DataFrame, orders: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Size and averages of each segment."""
    n = F.col("customer_count")
    return (
        _segmented(customers, orders, as_of)
        .groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("recency_days").cast("bigint").alias("days"),
            F.sum("n_orders").alias("orders"),
            F.sum("net_cents").alias("net_cents"),
            F.count("net_cents").alias("valued"),
            F.sum("rfm_total").cast("bigint").alias("scores"),
            F.min("rfm_total").alias("min_rfm_score"),
            F.max("rfm_total").alias("max_rfm_score"),
        )
        .select(
            "rfm_segment", "customer_count",
            mean_tenths(F.col("days"), n).alias("avg_recency_days"),
            mean_tenths(F.col("orders"), n).alias("avg_frequency"),
            mean_money(F.col("net_cents"), F.col("valued")).alias("avg_monetary"),
            mean_tenths(F.col("scores"), n).alias("avg_rfm_score"),
            "min_rfm_score", "max_rfm_score",
        )
        .orderBy(F.desc("avg_rfm_score"), "rfm_segment")
    )


def rfm_segments_brief(customers: DataFrame, orders: DataFrame, as_of: str | dt.date) -> DataFrame:
    return rfm_segments(customers, orders, as_of).drop("min_rfm_score", "max_rfm_score")
