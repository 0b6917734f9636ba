"""Business reports over the star.

Two habits keep them cheap on a large fact table. Facts are summed by their
foreign key before a dimension is joined, so the shuffle carries one partial
row per key and task, whatever the weight of a key; the dimension then meets a
small frame, and Spark chooses the join by size. Money is added up as integer
cents, so results do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.functions.exact import cents, growth_pct, mean_money, mean_tenths, money, percentage
from ordermart.functions.text import month_label, same_text

WEEK = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _rows() -> Column:
    return F.count(F.lit(1))


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(same_text(F.col("status"), "delivered"))


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).cast("bigint").alias(n) for n in names]


def _share(part: str) -> Column:
    """Percent of the column's total; for frames already aggregated to a few rows."""
    return percentage(F.col(part), F.sum(part).over(Window.partitionBy()))


def _by_day(orders: DataFrame, *extra: Column) -> DataFrame:
    """Orders and net cents per calendar key: at most one row per day and task is shuffled."""
    return orders.groupBy("date_id").agg(
        _rows().alias("total_orders"), F.sum(cents("net_total")).alias("net_cents"), *extra
    )


# ---- revenue over time -----------------------------------------------------

def _monthly(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    daily = _by_day(orders, F.sum("is_delivered").alias("delivered_orders"))
    return (
        daily.join(calendar.select("date_id", "year", "month", "month_name"), "date_id")
        .groupBy("year", "month", "month_name")
        .agg(*_sums("total_orders", "net_cents", "delivered_orders"))
    )


def _with_previous(monthly: DataFrame) -> DataFrame:
    # One row per month: a single task is enough for this window.
    return monthly.withColumn("previous_cents", F.lag("net_cents").over(Window.orderBy("year", "month")))


def monthly_revenue_trend(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue without cancelled orders, per delivered order, and its growth on the month before."""
    kept = orders.filter(F.lower("status") != "cancelled")
    return (
        _with_previous(_monthly(kept, calendar))
        .select(
            "year", "month", "month_name",
            money("net_cents").alias("net_revenue_inr"),
            "total_orders", "delivered_orders",
            mean_money(F.col("net_cents"), F.col("delivered_orders")).alias("avg_order_value"),
            growth_pct(F.col("net_cents"), F.col("previous_cents")).alias("mom_growth_pct"),
        )
        .orderBy("year", "month")
    )


def monthly_revenue_trend_rounded(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trend with the previous revenue shown; the status must match in case."""
    kept = orders.filter(F.col("status") != "Cancelled")
    return (
        _with_previous(_monthly(kept, calendar))
        .select(
            "year", "month", "month_name",
            money("net_cents").alias("net_revenue"),
            "total_orders", "delivered_orders",
            money("previous_cents").alias("prev_revenue"),
            growth_pct(F.col("net_cents"), F.col("previous_cents")).alias("mom_growth_pct"),
            month_label(F.col("year"), F.col("month")).alias("date_str"),
        )
        .orderBy("year", "month")
    )


def monthly_growth(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Months that have a growth figure."""
    trend = monthly_revenue_trend_rounded(orders, calendar)
    return trend.select("date_str", "mom_growth_pct").dropna(subset=["mom_growth_pct"]).orderBy("date_str")


def monthly_trend_delivered(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        _monthly(orders.filter(F.col("is_delivered") == 1), calendar)
        .select(
            "year", "month", "month_name",
            money("net_cents").alias("net_revenue"),
            F.col("total_orders").alias("orders"),
            month_label(F.col("year"), F.col("month")).alias("date_str"),
        )
        .orderBy("year", "month")
    )


def yearly_revenue(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        _by_day(_delivered(orders))
        .join(calendar.select("date_id", "year"), "date_id")
        .groupBy("year")
        .agg(money(F.sum("net_cents")).alias("revenue"))
    )


def orders_between(orders: DataFrame, first_key: int, last_key: int) -> DataFrame:
    """Daily orders and revenue for an inclusive range of calendar keys; the range reaches the scan."""
    return (
        _by_day(orders.filter(F.col("date_id").between(first_key, last_key)))
        .select("date_id", "total_orders", money("net_cents").alias("net_revenue"))
        .orderBy("date_id")
    )


# ---- merchants and items ---------------------------------------------------

def _by_restaurant(orders: DataFrame, *extra: Column) -> DataFrame:
    return orders.groupBy("restaurant_id").agg(
        _rows().alias("total_orders"),
        F.sum("delivery_time_min").cast("bigint").alias("minutes"),
        F.count("delivery_time_min").alias("timed"),
        *extra,
    )


def top_restaurants(orders: DataFrame, restaurants: DataFrame, limit: int = 10) -> DataFrame:
    """Merchants by revenue over orders of every status."""
    totals = _by_restaurant(
        orders,
        F.sum(cents("net_total")).alias("net_cents"),
        F.count("net_total").alias("priced"),
        F.sum("is_delivered").alias("delivered"),
    )
    names = restaurants.select("restaurant_id", F.col("name").alias("restaurant_name"), "city", "cuisine_type", "rating")
    return (
        totals.join(names, "restaurant_id")
        .orderBy(F.col("net_cents").desc_nulls_last(), "restaurant_id")
        .limit(limit)
        .select(
            "restaurant_id", "restaurant_name", "city", "cuisine_type", "rating", "total_orders",
            money("net_cents").alias("net_revenue"),
            mean_money(F.col("net_cents"), F.col("priced")).alias("avg_order_value"),
            mean_tenths(F.col("minutes"), F.col("timed")).alias("avg_delivery_min"),
            percentage(F.col("delivered"), F.col("total_orders")).alias("delivery_success_rate"),
        )
    )


def top_items(items: DataFrame, menu: DataFrame, restaurants: DataFrame, limit: int = 10) -> DataFrame:
    """Items by revenue, with the number of distinct orders."""
    # One row per item and order first: this makes the distinct count a plain
    # count, and a best-selling item is spread over its orders.
    per_order = items.groupBy("item_id", "order_id").agg(
        F.sum("quantity").cast("bigint").alias("units"),
        F.sum(cents("revenue")).alias("revenue_cents"),
        F.sum(cents("unit_price")).alias("price_cents"),
        F.count("unit_price").alias("priced"),
    )
    totals = per_order.groupBy("item_id").agg(
        *_sums("units", "revenue_cents", "price_cents", "priced"), F.count("order_id").alias("orders")
    )
    offered = menu.select("item_id", "item_name", "category", "restaurant_id").join(
        restaurants.select("restaurant_id", "cuisine_type"), "restaurant_id"
    )
    return (
        totals.join(offered, "item_id")
        .orderBy(F.col("revenue_cents").desc_nulls_last(), "item_id")
        .limit(limit)
        .select(
            "item_id", "item_name", "category", "cuisine_type",
            F.col("units").alias("total_units_sold"),
            "orders",
            money("revenue_cents").alias("total_revenue"),
            mean_money(F.col("price_cents"), F.col("priced")).alias("avg_price"),
        )
    )


def cancellation_by_segment(orders: DataFrame, restaurants: DataFrame, least_orders: int = 100) -> DataFrame:
    """Cancellation rate by city and cuisine, for groups with enough orders."""
    totals = _by_restaurant(orders, F.sum("is_cancelled").alias("cancelled_orders"))
    return (
        totals.join(restaurants.select("restaurant_id", "city", "cuisine_type"), "restaurant_id")
        .groupBy("city", "cuisine_type")
        .agg(*_sums("total_orders", "cancelled_orders", "minutes", "timed"))
        .filter(F.col("total_orders") >= least_orders)
        .select(
            "city", "cuisine_type", "total_orders", "cancelled_orders",
            percentage(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate"),
            mean_tenths(F.col("minutes"), F.col("timed")).alias("avg_delivery"),
        )
        .orderBy(F.desc("cancellation_rate"), "city", "cuisine_type")
    )


def cancellation_top(orders: DataFrame, restaurants: DataFrame, limit: int = 15) -> DataFrame:
    return cancellation_by_segment(orders, restaurants).limit(limit)


# ---- demand ----------------------------------------------------------------

def hourly_demand(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Delivered orders and revenue by weekday name and hour."""
    return (
        _delivered(orders)
        .groupBy("date_id", "order_hour")
        .agg(_rows().alias("orders"), F.sum(cents("net_total")).alias("net_cents"))
        .join(calendar.select("date_id", "day_name"), "date_id")
        .groupBy("day_name", "order_hour")
        .agg(*_sums("orders", "net_cents"))
        .select("day_name", "order_hour", "orders", money("net_cents").alias("revenue"))
        .orderBy("day_name", "order_hour")
    )


def demand_heatmap(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Weekdays Monday to Sunday by hours 0 to 23, mean orders, 0 where none."""
    hours = list(range(24))
    cells = hourly_demand(orders, calendar).groupBy("day_name").pivot("order_hour", hours).agg(F.avg("orders"))
    return (
        calendar.select("day_name", "day_of_week").distinct()
        .join(cells, "day_name", "left")
        .orderBy("day_of_week")
        .selectExpr("day_name", *[f"coalesce(`{hour}`, 0D) AS h{hour}" for hour in hours])
    )


# ---- couriers --------------------------------------------------------------

def _by_agent(orders: DataFrame) -> DataFrame:
    """All assigned orders, whatever their status."""
    return (
        orders.groupBy("agent_id")
        .agg(
            _rows().alias("deliveries"),
            F.sum("delivery_time_min").cast("bigint").alias("minutes"),
            F.count("delivery_time_min").alias("timed"),
            F.sum(cents("net_total")).alias("net_cents"),
        )
        .select(
            "agent_id", "deliveries",
            mean_tenths(F.col("minutes"), F.col("timed")).alias("avg_time"),
            money("net_cents").alias("total_value"),
        )
    )


def agent_performance(orders: DataFrame, agents: DataFrame) -> DataFrame:
    return (
        _by_agent(orders)
        .join(agents.select("agent_id", "name"), "agent_id")
        .select("agent_id", "name", "deliveries", "avg_time", "total_value")
        .orderBy(F.desc("deliveries"), "agent_id")
    )


def agent_leaderboard(orders: DataFrame, agents: DataFrame, limit: int = 15) -> DataFrame:
    return (
        _by_agent(orders)
        .join(agents.select("agent_id", "name", "city", "vehicle", "performance_tier"), "agent_id")
        .select(
            "agent_id", "name", "city", "vehicle", "performance_tier", "deliveries", "avg_time", "total_value"
        )
        .orderBy(F.desc("deliveries"), "agent_id")
        .limit(limit)
    )


def deliveries_by_tier_box(orders: DataFrame, agents: DataFrame) -> DataFrame:
    """Quartiles of deliveries per courier by tier, with fences at 1.5 interquartile ranges.

    Couriers are counted per delivery total first, so that a tier's task sees
    distinct totals with their frequencies instead of one row per courier.
    """
    per_total = (
        orders.groupBy("agent_id").agg(_rows().alias("deliveries"))
        .join(agents.select("agent_id", "performance_tier"), "agent_id")
        .groupBy("performance_tier", "deliveries")
        .agg(_rows().alias("agents"))
    )
    points = F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])
    box = per_total.groupBy("performance_tier").agg(
        F.sum("agents").alias("agents"),
        F.percentile(F.col("deliveries"), points, F.col("agents")).alias("at"),
    )
    at = [F.col("at")[i] for i in range(5)]
    spread = (at[3] - at[1]) * 1.5
    return box.select(
        "performance_tier", "agents",
        at[0].alias("min_deliveries"), at[1].alias("q1"), at[2].alias("median"), at[3].alias("q3"),
        at[4].alias("max_deliveries"),
        (at[1] - spread).alias("lower_fence"), (at[3] + spread).alias("upper_fence"),
    ).orderBy(F.asc_nulls_last("performance_tier"))


# ---- splits and headline figures -------------------------------------------

def _platforms(orders: DataFrame) -> DataFrame:
    return orders.groupBy("platform").agg(
        _rows().alias("orders"), money(F.sum(cents("net_total"))).alias("revenue")
    )


def platform_split(orders: DataFrame) -> DataFrame:
    return _platforms(_delivered(orders))


def platform_split_by_flag(orders: DataFrame) -> DataFrame:
    return _platforms(orders.filter(F.col("is_delivered") == 1))


def kpi_strip(orders: DataFrame) -> DataFrame:
    """Headline figures in one row; every ratio is null when it has nothing to divide by."""
    done = F.col("is_delivered") == 1
    net = F.when(done, cents("net_total"))
    minutes = F.when(done, F.col("delivery_time_min"))
    # Summed per customer, whose number is then a count of rows; merchants are counted in a narrow pass of their own.
    per_customer = orders.groupBy("customer_id").agg(
        _rows().alias("total_orders"),
        F.sum(F.when(done, 1).otherwise(0)).alias("delivered"),
        F.sum(F.when(F.col("is_cancelled") == 1, 1).otherwise(0)).alias("cancelled"),
        F.sum(F.when(done, cents("net_total")).otherwise(0)).alias("net_cents"),
        F.count(net).alias("priced"),
        F.sum(minutes).cast("bigint").alias("minutes"),
        F.count(minutes).alias("timed"),
    )
    summed = ("delivered", "cancelled", "net_cents", "minutes")
    totals = per_customer.agg(
        F.count("customer_id").alias("unique_customers"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("total_orders", "priced", "timed")],
        *[F.sum(n).cast("bigint").alias(n) for n in summed],
    )
    shops = orders.groupBy("restaurant_id").agg(_rows()).agg(F.count("restaurant_id")).scalar()
    return totals.withColumn("unique_restaurants", shops).select(
        "total_orders", "delivered", "cancelled",
        money("net_cents").alias("net_revenue"),
        mean_money(F.col("net_cents"), F.col("priced")).alias("avg_order_value"),
        mean_tenths(F.col("minutes"), F.col("timed")).alias("avg_delivery_min"),
        "unique_customers", "unique_restaurants",
        mean_tenths(F.col("delivered") * 100, F.col("total_orders")).alias("delivery_rate_pct"),
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("status").agg(_rows().alias("orders"))
    return counts.select("status", "orders", _share("orders").alias("share_pct"))


def segment_counts(customers: DataFrame) -> DataFrame:
    counts = customers.groupBy("customer_segment").agg(_rows().alias("cnt"))
    return counts.select("customer_segment", "cnt", _share("cnt").alias("share_pct")).orderBy(
        F.desc("cnt"), "customer_segment"
    )
