"""Every query of the engine over the given tables, by name.

Row-level cleaning and the star builders run on the raw sources; reports run on
the star that is loaded once per application (see ``driver_views.star``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart import driver_views as dv
from ordermart.functions.bands import band
from ordermart.functions.dates import as_date, date_key, day_name, days_until, is_weekend, month_name
from ordermart.functions.text import clean_email, clean_name, strip
from ordermart.operators.dedup import keep_first
from ordermart.operators.ranking import ntile_scores
from ordermart.plans import forecast as fc, incremental
from ordermart.plans import group_forecast as gf
from ordermart.plans import marts, quality, reports, segments
from ordermart.plans.job import read_fact_range
from ordermart.plans.star import (
    AGENT_TIERS, RATING_BANDS, TIME_OF_DAY, agent_dim, customer_dim, line_total, menu_item_dim, order_fact,
    order_item_fact, restaurant_dim,
)
from ordermart.schemas import FINDINGS, FORECAST, METRICS, MONTHLY_MART, SOURCES, Table
from ordermart.session import scratch_path
from ordermart.sources.readers import read_present, read_sources, run_sql
from ordermart.sources.staging import stage
from ordermart.sources.writers import conform, create_if_absent, current_version, publish, publish_version, replace_table

Query = Callable[[SparkSession, str], DataFrame]

# An earlier load ended here; the mart as it then was is the upsert target.
EARLIER_LOAD_END = 19991231
RANGE = (19960101, 19971231)
# Least rows per source for the gate over the given tables.
MINIMUMS = {
    "customers": 1000, "restaurants": 500, "menu_items": 1000, "delivery_agents": 10,
    "orders": 10000, "order_items": 50000, "payments": 10000,
}
RUN_AT = dt.datetime(2001, 8, 1, 2, 30)


def portable(frame: DataFrame) -> DataFrame:
    """Types every SQL engine renders alike: BIGINT, DOUBLE, BOOLEAN, text."""

    def column(field: T.StructField):
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            target = "double"
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            target = "bigint"
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            target = "string"
        else:
            return F.col(field.name)
        return F.col(field.name).cast(target).alias(field.name)

    return frame.select(*[column(f) for f in frame.schema.fields])


# ---- cleaning --------------------------------------------------------------

def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines by (order, line number), which several distinct lines share."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_number")
    shared = lines.select(dv.line_id(lines).alias("order_item_id"), number)
    items = dv.raw_sources(spark, sf_dir)["order_items"].join(shared, "order_item_id")
    order = ["order_id", "item_id", "quantity", "unit_price", "line_total", "order_item_id"]
    return keep_first(items, "line_number", order).select("line_number", *order[:-1])


def _normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names joined by apostrophes, hyphens or blanks, padded with several kinds of blank."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = F.col("p_partkey")
    joint = F.when(key % 3 == 0, "'").when(key % 3 == 1, "-").otherwise(" ")
    messy = F.concat(F.lit("\t  "), F.replace(F.col("p_name"), F.lit(" "), joint), F.lit(" \n"))
    return part.select(
        key.alias("item_id"),
        strip(messy).alias("stripped"),
        clean_name(messy).alias("title"),
        clean_email(F.concat(F.lit("  "), F.upper("p_type"), F.lit("@Shop.COM\n"))).alias("email"),
    )


def _bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dv.raw_sources(spark, sf_dir)
    return raw["restaurants"].select(
        "restaurant_id", "rating",
        band(F.col("rating"), RATING_BANDS).alias("rating_band"),
        band(F.col("rating"), AGENT_TIERS).alias("tier"),
    )


def _time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hour = F.hour("ts")
    return events.groupBy(hour.alias("event_hour"), band(hour, TIME_OF_DAY).alias("time_of_day")).agg(
        F.count(F.lit(1)).alias("events")
    )


def _date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.to_date("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        date_key(day).alias("date_id"),
        month_name(day).alias("month_name"),
        day_name(day).alias("day_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week"),
        F.weekday(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
        days_until(dv.AS_OF, day).alias("age_days"),
        as_date(day.cast("string")).alias("parsed"),
    )


def _customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_dim(dv.raw_sources(spark, sf_dir)["customers"], dv.AS_OF)
    return customers.select("customer_id", "is_premium", "tenure_days", "customer_segment")


def _spend_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartile of every order by value, over the whole order table."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    falling = {"quartile": -F.rint(F.col("o_totalprice") * 100)}  # prices have two decimals
    return ntile_scores(orders, "o_orderkey", falling, 4).select("o_orderkey", "quartile")


# ---- star ------------------------------------------------------------------

def _raw(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(dv.raw_sources(spark, sf_dir))


def _order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dv.raw_sources(spark, sf_dir)
    return order_fact(raw["orders"], raw["payments"], dv.calendar(spark, sf_dir))


def _order_item_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dv.raw_sources(spark, sf_dir)
    return order_item_fact(raw["order_items"], _order_fact(spark, sf_dir))


# ---- reports ---------------------------------------------------------------

def _over(report: Callable[..., DataFrame], *tables: str, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = dv.star(spark, sf_dir)
        return report(*[star[t] for t in tables], **options)

    return query


ORDERS, ITEMS, DAYS = "fact_orders", "fact_order_items", "dim_date"
BUYERS, SHOPS, MENU, AGENTS = "dim_customer", "dim_restaurant", "dim_menu_item", "dim_delivery_agent"


def _events_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the event stream by weekday and hour, through the same report."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    day = F.to_date("ts")
    as_orders = events.select(
        date_key(day).alias("date_id"),
        F.hour("ts").alias("order_hour"),
        F.when(F.col("event_type") == "purchase", "Delivered").otherwise("Cancelled").alias("status"),
        F.col("value").cast("decimal(18,2)").alias("net_total"),
    )
    bounds = events.agg(F.to_date(F.min("ts")).alias("first_day"), F.to_date(F.max("ts")).alias("last_day"))
    return reports.hourly_demand(as_orders, dv.calendar_of(bounds))


def _sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT d.quarter, f.platform, f.time_of_day,
               count(*) FILTER (WHERE f.is_delivered = 1) AS delivered,
               count(DISTINCT f.customer_id) AS customers
        FROM fact_orders f JOIN dim_date d ON f.date_id = d.date_id
        GROUP BY d.quarter, f.platform, f.time_of_day"""
    return run_sql(spark, text, dv.star(spark, sf_dir))


def _mart_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = dv.star(spark, sf_dir)
    orders, days, shops = star[ORDERS], star[DAYS], star[SHOPS]
    earlier = marts.mart_for_refresh(orders.filter(F.col("date_id") <= EARLIER_LOAD_END), days, shops)
    return marts.merge_mart(earlier, marts.mart_for_upsert(orders, days, shops))


def _date_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_fact_range(spark, dv.star_path(spark, sf_dir), ORDERS, *RANGE)
    return reports.orders_between(orders, *RANGE)


# ---- written tables, read back ---------------------------------------------

def _csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders written as CSV and read with their declared schema."""
    path = scratch_path(spark, "raw")
    orders = dv.raw_sources(spark, sf_dir)["orders"]
    orders.write.csv(f"{path}/orders.csv", header=True, escape='"')
    return read_sources(spark, path, tables={"orders": SOURCES["orders"]}, strict=True)["orders"]


def _mart_refresh_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshing twice leaves what refreshing once does."""
    star, root = dv.star(spark, sf_dir), scratch_path(spark, MONTHLY_MART.name)
    for version in ("1", "2"):
        marts.refresh_mart(root, version, star[ORDERS], star[DAYS], star[SHOPS])
    return current_version(spark, root).select(*MONTHLY_MART.columns)


def _mart_upsert_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of an earlier load, upserted with a later one and then again, read through its manifest."""
    star, root = dv.star(spark, sf_dir), scratch_path(spark, MONTHLY_MART.name)
    orders, days, shops = star[ORDERS], star[DAYS], star[SHOPS]
    marts.seed_mart(root, "1", orders.filter(F.col("date_id") <= EARLIER_LOAD_END), days, shops)
    for version in ("2", "3"):
        marts.upsert_mart(root, version, orders, days, shops)
    return marts.upserted_mart(spark, root)


def _mart_changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of an earlier load with orders that were changed and deleted since, refreshed where they differ."""
    star, root = dv.star(spark, sf_dir), scratch_path(spark, MONTHLY_MART.name)
    orders, days, shops = star[ORDERS], star[DAYS], star[SHOPS]
    earlier = orders.filter(F.col("date_id") <= EARLIER_LOAD_END)
    once = earlier.filter("date_id % 100 <> 1").withColumn("net_total", F.when(F.col("date_id") % 1000 > 700, F.col("net_total")))
    incremental.refresh_changed(root, "1", once, days, shops)
    incremental.refresh_changed(root, "2", orders, days, shops)
    return incremental.refreshed_mart(spark, root)


def _parquet_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders written as Parquet with a column too many, and read as a declared source."""
    path = scratch_path(spark, "raw")
    dv.raw_sources(spark, sf_dir)["orders"].withColumn("extra", F.lit(1)).write.parquet(f"{path}/orders.parquet")
    return read_sources(spark, path, "parquet", {"orders": SOURCES["orders"]})["orders"]


def _catalog_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart in a catalog table, created if absent and replaced as a whole."""
    star = dv.star(spark, sf_dir)
    declared = dataclasses.replace(MONTHLY_MART, name=f"ordermart_mart_{uuid.uuid4().hex}")
    create_if_absent(spark, declared, partition_by=marts.PARTITIONS)
    for _ in range(2):
        replace_table(marts.mart_for_refresh(star[ORDERS], star[DAYS], star[SHOPS]), declared, marts.PARTITIONS)
    return spark.table(declared.name).select(*declared.columns)


def _line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = dv.raw_sources(spark, sf_dir)["order_items"]
    return items.select("order_item_id", line_total(F.col("quantity"), F.col("unit_price")).alias("line_total"))


def _load_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of a load, written with it and read back."""
    root = scratch_path(spark, FINDINGS.name)
    publish_version(quality.findings(dv.raw_sources(spark, sf_dir), dv.star(spark, sf_dir)), root, "1")
    return current_version(spark, root)


def _metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error measures of the earlier and the whole series, appended run by run."""
    series, path = _series(spark, sf_dir), scratch_path(spark, METRICS.name)
    for run_at, seen in ((dt.datetime(2000, 1, 1), series.filter(date_key(F.col("ds")) <= EARLIER_LOAD_END)), (RUN_AT, series)):
        publish(fc.stamped(fc.error_metrics(seen, _week_before(seen)), run_at), path, mode="append")
    return spark.read.parquet(path)


# ---- quality ---------------------------------------------------------------

def _source_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.source_gate(spark, dv.raw_sources(spark, sf_dir), MINIMUMS)


def _staged_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate from the counts taken while the sources are copied, the couriers being absent."""
    sources = {**dv.raw_sources(spark, sf_dir), "delivery_agents": None}
    return quality.counted_gate(spark, stage(spark, sources, scratch_path(spark, "staged")).counts, MINIMUMS)


def _missing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over the given tables as sources, with a price list and payments that are not there."""
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "price_list": "item", "payments": "id"}
    tables = {name: Table(name, T.StructType().add(key, "string"), (key,)) for name, key in keys.items()}
    present = read_present(spark, sf_dir, "parquet", tables)
    return quality.source_gate(spark, present, dict.fromkeys(tables, 1))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders written as text, some with fields that do not fit, and read by a load that sets these apart."""
    raw, path = dv.raw_sources(spark, sf_dir), scratch_path(spark, "raw")

    def put(name: str, **wrong: tuple[int, str]) -> None:
        key = F.col(SOURCES[name].key[0]).cast("bigint")
        texts = {c: F.trim(F.translate(F.col(c).cast("string"), "\n\t", "  ")) for c in SOURCES[name].columns}
        for column, (step, text) in wrong.items():
            texts[column] = F.when(key % step == 0, F.lit(text)).otherwise(texts[column])
        raw[name].select(*[text.alias(c) for c, text in texts.items()]).write.csv(f"{path}/{name}.csv", header=True, escape='"')

    put("customers", registration_date=(499, "2001-02-30"), is_premium=(998, "perhaps"))
    put("orders", delivery_time_min=(9973, "soon"), order_timestamp=(14983, "yesterday"))
    tables = {name: SOURCES[name] for name in ("customers", "orders")}
    staged = stage(spark, read_present(spark, path, tables=tables, ingest=True), scratch_path(spark, "staged"), tables)
    good = [
        staged.frames[name].agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("source"), F.lit("").alias("key"), F.lit("fit").alias("reason"), "n"
        ) for name in tables
    ]
    bad = staged.quarantined.select(
        "source", F.substring_index("record", ",", 1).alias("key"), F.array_join("reasons", "; ").alias("reason"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return bad.unionByName(good[0]).unionByName(good[1])


def _flag_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mismatches in the fact, and in a copy whose flag marks every order that was not cancelled."""
    fact = dv.star(spark, sf_dir)[ORDERS]
    loose = fact.withColumn("is_delivered", 1 - F.col("is_cancelled"))
    count = F.count(F.lit(1)).alias("violations")
    return (
        quality.flag_mismatches(fact).agg(count).select(F.lit("as loaded").alias("checked"), "violations")
        .unionByName(quality.flag_mismatches(loose).agg(count).select(F.lit("loose flag").alias("checked"), "violations"))
    )


def _raw_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_audit(dv.raw_sources(spark, sf_dir), SOURCES)


def _star_audit(audit: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: audit(dv.star(spark, sf_dir))


# ---- forecast --------------------------------------------------------------

def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = dv.star(spark, sf_dir)
    return fc.daily_series(star[ORDERS], star[DAYS])


def _forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.future_only(fc.fit_and_predict(_series(spark, sf_dir)), RUN_AT)


def _forecast_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast as stored: written twice, as by a retry, and read back."""
    root = scratch_path(spark, FORECAST.name)
    for _ in range(2):
        publish_version(conform(_forecast(spark, sf_dir), FORECAST), root, "1")
    return current_version(spark, root)


def _forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = fc.fit_and_predict(_series(spark, sf_dir))
    return fc.error_metrics(fc.observed(predicted), predicted)


def _week_before(series: DataFrame) -> DataFrame:
    """Each day predicted by the same weekday a week earlier: exact input for the error measures."""
    return series.select(F.date_add("ds", 7).alias("ds"), F.col("y").cast("double").alias("yhat"))


def _error_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _series(spark, sf_dir)
    return fc.error_metrics(series, _week_before(series))


def _latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.latest_metrics(_metrics_history(spark, sf_dir))


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = dv.star(spark, sf_dir)
    return gf.fit_and_predict_by(gf.daily_series_by(star[ORDERS], star[DAYS], star[SHOPS]))


def _forecast_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.forecast_listing(_forecast_written(spark, sf_dir), days=7)


_QUERIES: dict[str, Query] = {
    # cleaning and conforming
    "dedup_keep_first": _dedup,
    "normalize_text": _normalize,
    "band_right_closed": _bands,
    "time_of_day_band": _time_of_day,
    "date_functions": _date_functions,
    "customer_segments": _customer_segments,
    # star
    "customer_dim": _raw(lambda raw: customer_dim(raw["customers"], dv.AS_OF)),
    "restaurant_dim": _raw(lambda raw: restaurant_dim(raw["restaurants"])),
    "menu_item_dim": _raw(lambda raw: menu_item_dim(raw["menu_items"], dv.PRICE_BANDS)),
    "agent_dim": _raw(lambda raw: agent_dim(raw["delivery_agents"], dv.AS_OF)),
    "calendar_dim": dv.calendar,
    "line_totals": _line_totals,
    "payment_derivation": _raw(lambda raw: raw["payments"]),
    "order_fact": _order_fact,
    "order_item_fact": _order_item_fact,
    # reports
    "monthly_revenue_trend": _over(reports.monthly_revenue_trend, ORDERS, DAYS),
    "monthly_revenue_trend_rounded": _over(reports.monthly_revenue_trend_rounded, ORDERS, DAYS),
    "monthly_growth": _over(reports.monthly_growth, ORDERS, DAYS),
    "monthly_trend_delivered": _over(reports.monthly_trend_delivered, ORDERS, DAYS),
    "yearly_revenue": _over(reports.yearly_revenue, ORDERS, DAYS),
    "date_key_range": _date_key_range,
    "top_restaurants": _over(reports.top_restaurants, ORDERS, SHOPS),
    "top_items": _over(reports.top_items, ITEMS, MENU, SHOPS),
    "cancellation_by_segment": _over(reports.cancellation_by_segment, ORDERS, SHOPS),
    "cancellation_top15": _over(reports.cancellation_top, ORDERS, SHOPS),
    "hourly_demand": _over(reports.hourly_demand, ORDERS, DAYS),
    "hourly_demand_events": _events_demand,
    "demand_heatmap": _over(reports.demand_heatmap, ORDERS, DAYS),
    "agent_performance": _over(reports.agent_performance, ORDERS, AGENTS),
    "agent_top15": _over(reports.agent_leaderboard, ORDERS, AGENTS),
    "deliveries_by_tier_box": _over(reports.deliveries_by_tier_box, ORDERS, AGENTS),
    "platform_split": _over(reports.platform_split, ORDERS),
    "platform_split_by_flag": _over(reports.platform_split_by_flag, ORDERS),
    "kpi_strip": _over(reports.kpi_strip, ORDERS),
    "status_distribution": _over(reports.status_distribution, ORDERS),
    "segment_counts": _over(reports.segment_counts, BUYERS),
    "sql_text": _sql_text,
    # segments
    "order_value_quartiles": _spend_quartiles,
    "customer_lifetime_value": _over(segments.customer_lifetime_value, BUYERS, ORDERS, as_of=dv.AS_OF),
    "clv_top20": _over(segments.clv_top, BUYERS, ORDERS),
    "rfm_customers": _over(segments.rfm_customers, BUYERS, ORDERS, as_of=dv.AS_OF),
    "rfm_segments": _over(segments.rfm_segments, BUYERS, ORDERS, as_of=dv.AS_OF),
    "rfm_segments_brief": _over(segments.rfm_segments_brief, BUYERS, ORDERS, as_of=dv.AS_OF),
    # marts
    "monthly_mart_refresh": _over(marts.mart_for_refresh, ORDERS, DAYS, SHOPS),
    "monthly_mart_upsert": _mart_upsert,
    # written tables, read back
    "csv_orders": _csv_orders,
    "fact_orders_written": lambda spark, sf_dir: dv.star(spark, sf_dir)[ORDERS],
    "fact_order_items_written": lambda spark, sf_dir: dv.star(spark, sf_dir)[ITEMS],
    "parquet_orders": _parquet_orders,
    "catalog_mart": _catalog_mart,
    "mart_refresh_written": _mart_refresh_written,
    "mart_upsert_written": _mart_upsert_written,
    "mart_changed_months_written": _mart_changed_months,
    "span_figures_check": _over(incremental.span_check, ORDERS, DAYS),
    "metrics_history_written": _metrics_history,
    # quality
    "source_gate": _source_gate,
    "source_gate_staged": _staged_gate,
    "missing_sources": _missing_sources,
    "quarantined_rows": _quarantine,
    "null_profile": _raw(quality.null_profiles),
    "duplicate_profile": _raw(quality.duplicate_profiles),
    "not_null_audit": _star_audit(quality.not_null_audit),
    "pk_audit": _star_audit(quality.key_audit),
    "pk_audit_raw": _raw_key_audit,
    "fk_orphans": _star_audit(quality.foreign_key_audit),
    "flag_consistency": _flag_consistency,
    "domain_audit": _star_audit(quality.domain_audit),
    "table_row_counts": _star_audit(quality.row_counts),
    "load_findings": _load_findings,
    # forecast
    "daily_series": _series,
    "forecast_features": lambda spark, sf_dir: fc.model_frame(_series(spark, sf_dir)),
    "forecast_daily": _forecast,
    "forecast_written": _forecast_written,
    "forecast_preview": _forecast_preview,
    "forecast_metrics": _forecast_metrics,
    "error_metrics": _error_metrics,
    "daily_series_by_group": _over(gf.daily_series_by, ORDERS, DAYS, SHOPS),
    "forecast_by_group": lambda spark, sf_dir: gf.future_by(_grouped(spark, sf_dir), RUN_AT),
    "forecast_metrics_by_group": lambda spark, sf_dir: gf.error_metrics_by(_grouped(spark, sf_dir)),
    "latest_metrics": _latest_metrics,
}


def queries() -> dict[str, Query]:
    def exported(query: Query) -> Query:
        return lambda spark, sf_dir: portable(query(spark, sf_dir))

    return {name: exported(query) for name, query in _QUERIES.items()}
