"""Monthly mart by city and cuisine: full refresh and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions.exact import cents, mean_money, money, rounded_ratio
from ordermart.operators.upsert import upsert
from ordermart.operators.versioned import read_versioned, upsert_versioned, write_versioned
from ordermart.schemas import MONTHLY_MART
from ordermart.sources.writers import conform, publish_version

KEYS = MONTHLY_MART.key
PARTITIONS = ("year", "month")
UPDATED = ("net_revenue",)


def _monthly_mart(orders: DataFrame, calendar: DataFrame, restaurants: DataFrame, averaged: Column) -> DataFrame:
    """Totals per month, city and cuisine; averages over the orders where ``averaged`` holds.

    The calendar has one row per day and is broadcast, which gives the month.
    Orders are then summed per month and merchant before merchants are joined.
    """
    months = calendar.select("date_id", "year", "month", "month_name")
    net = F.when(averaged, cents("net_total"))
    minutes = F.when(averaged, F.col("delivery_time_min"))
    measures = {
        "total_orders": F.count("order_id"),
        "delivered_orders": F.count_if(F.col("is_delivered") == 1),
        "cancelled_orders": F.count_if(F.col("is_cancelled") == 1),
        "gross_cents": F.sum(cents("gross_total")),
        "net_cents": F.sum(cents("net_total")),
        "avg_cents": F.sum(net),
        "avg_priced": F.count(net),
        "minutes": F.sum(minutes).cast("bigint"),
        "timed": F.count(minutes),
    }
    return (
        orders.join(F.broadcast(months), "date_id")
        .groupBy("year", "month", "month_name", "restaurant_id")
        .agg(*[measure.alias(name) for name, measure in measures.items()])
        .join(restaurants.select("restaurant_id", "city", "cuisine_type"), "restaurant_id")
        .groupBy("year", "month", "month_name", "city", "cuisine_type")
        .agg(*[F.sum(name).alias(name) for name in measures])
        .select(
            "year", "month", "month_name", "city", "cuisine_type",
            "total_orders", "delivered_orders", "cancelled_orders",
            money("gross_cents").alias("gross_revenue"),
            money("net_cents").alias("net_revenue"),
            mean_money(F.col("avg_cents"), F.col("avg_priced")).alias("avg_order_value"),
            rounded_ratio(F.col("minutes"), F.col("timed"), 2).alias("avg_delivery_min"),
        )
    )


def mart_for_refresh(orders: DataFrame, calendar: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Mart whose averages cover delivered orders only."""
    return _monthly_mart(orders, calendar, restaurants, F.col("is_delivered") == 1)


def mart_for_upsert(orders: DataFrame, calendar: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Mart whose averages cover all orders."""
    return _monthly_mart(orders, calendar, restaurants, F.lit(True))


def merge_mart(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """New keys are added; a known key takes only the new net revenue."""
    return upsert(target, incoming, KEYS, UPDATED)


def refresh_mart(root: str, version: str, orders: DataFrame, calendar: DataFrame, restaurants: DataFrame) -> str:
    """Write the mart as a new version under ``root``; returns the path of the version."""
    mart = conform(mart_for_refresh(orders, calendar, restaurants), MONTHLY_MART)
    return publish_version(mart, root, version, partition_by=PARTITIONS)


def seed_mart(root: str, version: str, orders: DataFrame, calendar: DataFrame, restaurants: DataFrame) -> None:
    """Start an upserted mart from a full refresh."""
    mart = conform(mart_for_refresh(orders, calendar, restaurants), MONTHLY_MART)
    write_versioned(mart, root, version, PARTITIONS)


def upsert_mart(
    root: str, version: str, orders: DataFrame, calendar: DataFrame, restaurants: DataFrame, keep: int = 3
) -> None:
    """Upsert the mart under ``root``: months of the given orders are written anew, the others stay as they are."""
    mart = conform(mart_for_upsert(orders, calendar, restaurants), MONTHLY_MART)
    upsert_versioned(mart, root, version, KEYS, UPDATED, PARTITIONS, keep)


def upserted_mart(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The upserted mart as of a version, by default the last complete one."""
    return read_versioned(spark, root, MONTHLY_MART.schema, version)
