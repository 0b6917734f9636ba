"""What is kept per month, so that a later load or a longer span need not read all orders again.

* ``refresh_changed``: the monthly mart, of which only the months whose orders differ
  from the last refresh are computed and written. A month's orders are compared by a
  digest that does not depend on their order and counts repeated rows.
* ``monthly_state`` / ``span_figures``: sketches of customers, merchants and delivery
  minutes per month, merged for any span of months. Exact figures stay the default
  (``reports.kpi_strip``); these are for spans over months that are costly to read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.operators.versioned import read_versioned, write_versioned
from ordermart.plans.marts import PARTITIONS, mart_for_refresh
from ordermart.schemas import MONTHLY_MART
from ordermart.sources.writers import complete_versions, conform, publish

#: Rows of 2^14 registers: a distinct count is off by 0.8 % (one standard error of merged sketches).
HLL_BITS, HLL_ERROR = 14, 0.0083
#: Items kept per level: a quantile's rank is off by at most 1.4 % of the rows in 99 of 100 sketches.
KLL_SIZE, KLL_ERROR = 200, 0.014
#: What the mart is computed from; another column of an order changes no month.
_READ = ("order_id", "date_id", "restaurant_id", "is_delivered", "is_cancelled", "gross_total", "net_total", "delivery_time_min")
_DIGESTS = "year int, month int, n long, total decimal(38,0), mark long"


def _digest(*columns: str) -> list[Column]:
    """Count, sum and exclusive or of row hashes: equal for equal multisets of rows, whatever their order.

    Nulls do not enter a row's hash by themselves, so their places are hashed along.
    """
    places = [F.col(c).isNull() for c in columns]
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*columns, *places).cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"),
        F.bit_xor(F.xxhash64(F.lit(1), *columns, *places)).alias("mark"),
    ]


def month_digests(orders: DataFrame, calendar: DataFrame, restaurants: DataFrame) -> DataFrame:
    """(year, month, n, total, mark) of the orders of each month, and of the merchants in a row without a month.

    One pass over eight columns, one row per month and task shuffled.
    """
    months = F.broadcast(calendar.select("date_id", F.col("year").cast("int"), F.col("month").cast("int")))
    of_orders = orders.select(*_READ).join(months, "date_id").groupBy("year", "month").agg(*_digest(*_READ))
    shops = restaurants.select("restaurant_id", "city", "cuisine_type")
    none = F.lit(None).cast("int")
    of_shops = shops.agg(*_digest(*shops.columns)).select(none.alias("year"), none.alias("month"), "n", "total", "mark")
    return of_orders.unionByName(of_shops)


def changed_months(spark: SparkSession, root: str, digests: DataFrame) -> list[tuple[int, int]]:
    """Months that are new, gone or different since the last complete version; one row per month is collected.

    All months where the merchants differ, as any of them may lie in any month.
    """
    complete = complete_versions(spark, f"{root}/manifests")
    past = set()
    if complete:
        past = {tuple(r) for r in spark.read.schema(_DIGESTS).parquet(f"{root}/digests/{complete[-1]}").collect()}
    now = {tuple(r) for r in digests.collect()}
    differ = past ^ now
    if any(r[0] is None for r in differ):
        differ = past | now
    return sorted({(r[0], r[1]) for r in differ if r[0] is not None})


def refresh_changed(
    root: str, version: str, orders: DataFrame, calendar: DataFrame, restaurants: DataFrame, keep: int = 3
) -> list[tuple[int, int]]:
    """Refresh the mart under ``root`` where its orders have changed; returns the months that were computed.

    The result equals a full refresh after late, changed and deleted orders. Months
    without orders leave the mart. The digests are written before the manifest names
    the version, so a failed refresh is done again in full by the next one.
    """
    spark = orders.sparkSession
    target = f"{root}/digests/{version}"
    digests = month_digests(orders, calendar, restaurants)
    changed = changed_months(spark, root, digests)
    publish(digests.select("year", "month", "n", "total", "mark").coalesce(1), target)
    in_month = [F.col("date_id").between(y * 10000 + m * 100, y * 10000 + m * 100 + 99) for y, m in changed]
    some = reduce(Column.__or__, in_month, F.lit(False))
    mart = conform(mart_for_refresh(orders.filter(some), calendar.filter(some), restaurants), MONTHLY_MART)
    gone = [f"{PARTITIONS[0]}={y}/{PARTITIONS[1]}={m}" for y, m in changed]
    write_versioned(mart, root, version, PARTITIONS, keep_others=True, keep=keep, without=gone)
    return changed


def refreshed_mart(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The mart as of a version, by default the last complete one."""
    return read_versioned(spark, root, MONTHLY_MART.schema, version)


def monthly_state(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per month with the number of orders and the sketches; a few tens of kilobytes each.

    Sketches are built before the shuffle, so a heavy month costs one sketch per task.
    Null customers, merchants and minutes enter no sketch.
    """
    minutes = F.when(F.col("is_delivered") == 1, F.col("delivery_time_min")).cast("bigint")
    months = F.broadcast(calendar.select("date_id", "year", "month"))
    return orders.join(months, "date_id").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.hll_sketch_agg("customer_id", HLL_BITS).alias("customers"),
        F.hll_sketch_agg("restaurant_id", HLL_BITS).alias("restaurants"),
        F.kll_sketch_agg_bigint(minutes, F.lit(KLL_SIZE)).alias("minutes"),
    )


def span_figures(state: DataFrame, *by: str) -> DataFrame:
    """Figures of the months of ``state`` together, or by ``by``: orders, distinct customers and merchants, median minutes."""
    timed = F.kll_sketch_get_n_bigint("minutes") > 0
    merged = state.groupBy(*by).agg(
        F.sum("total_orders").alias("total_orders"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"),
        F.hll_sketch_estimate(F.hll_union_agg("restaurants")).alias("restaurants"),
        F.kll_merge_agg_bigint(F.when(timed, F.col("minutes"))).alias("minutes"),
    )
    some = F.kll_sketch_get_n_bigint("minutes") > 0
    median = F.when(some, F.kll_sketch_get_quantile_bigint("minutes", F.lit(0.5)))
    return merged.select(*by, "total_orders", "customers", "restaurants", median.alias("median_minutes"))


def span_check(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per year the exact distinct counts, and whether the merged sketches lie within three standard errors.

    The median is in bound if the share of delivered orders below it, and up to it,
    lie on both sides of a half but for twice the rank error.
    """
    found = span_figures(monthly_state(orders, calendar), "year")
    placed = orders.join(F.broadcast(calendar.select("date_id", "year")), "date_id")
    exact = placed.groupBy("year").agg(
        F.countDistinct("customer_id").alias("exact_customers"), F.countDistinct("restaurant_id").alias("exact_restaurants"),
    )
    timed = placed.filter("is_delivered = 1 and delivery_time_min is not null")
    ranks = timed.join(F.broadcast(found.select("year", "median_minutes")), "year").groupBy("year").agg(
        F.avg((F.col("delivery_time_min") < F.col("median_minutes")).cast("int")).alias("below"),
        F.avg((F.col("delivery_time_min") <= F.col("median_minutes")).cast("int")).alias("upto"),
    )

    def near(name: str) -> Column:
        true = F.col(f"exact_{name}")
        return F.abs(F.col(name) - true) <= F.ceil(true * (3 * HLL_ERROR))

    median = (F.col("below") <= 0.5 + 2 * KLL_ERROR) & (F.col("upto") >= 0.5 - 2 * KLL_ERROR)
    return found.join(exact, "year").join(ranks, "year", "left").select(
        "year", "total_orders", "exact_customers", "exact_restaurants",
        near("customers").alias("customers_in_bound"), near("restaurants").alias("restaurants_in_bound"),
        F.coalesce(median, F.col("median_minutes").isNull()).alias("median_in_bound"),
    )
