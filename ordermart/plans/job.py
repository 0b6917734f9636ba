"""The daily job: gate, star, audits, mart, forecast."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions.bands import Bands
from ordermart.functions.dates import as_timestamp
from ordermart.operators.slices import slice_count, slices
from ordermart.plans import forecast as fc
from ordermart.plans import group_forecast as gf
from ordermart.plans import marts, quality
from ordermart.plans.calendar import HOLIDAYS, PEAK_MONTHS, calendar_dim
from ordermart.plans.star import (
    AS_OF, PRICE_BANDS, Order, agent_dim, customer_dim, menu_item_dim, order_fact, order_item_fact, restaurant_dim,
)
from ordermart.schemas import FINDINGS, FORECAST, GROUP_FORECAST, METRICS, MINIMUM_ROWS, MONTHLY_MART, QUARANTINE, STAR
from ordermart.session import child_names, remove_path, scratch_path, shuffles_removed
from ordermart.sources.readers import INGEST, read_present
from ordermart.sources.staging import stage
from ordermart.sources.writers import conform, publish, publish_version

FACT_PARTITIONS = ("order_year", "order_month")


class AuditFailed(ValueError):
    """The new star breaks a declared key; it was not made current."""


@dataclass(frozen=True)
class Settings:
    source_root: str
    warehouse: str
    source_format: str = "csv"
    multi_line: bool = False
    calendar_start: str | None = None
    calendar_end: str | None = None
    as_of: str = AS_OF
    horizon: int = 30
    run_at: dt.datetime = field(default_factory=dt.datetime.now)
    minimums: dict[str, int] = field(default_factory=lambda: dict(MINIMUM_ROWS))
    holidays: tuple[str, ...] = HOLIDAYS
    peak_months: tuple[int, ...] = PEAK_MONTHS
    price_bands: Bands = PRICE_BANDS
    keep_runs: int = 3
    quarantine: bool = False  # set rows apart that do not fit their types, instead of failing the run
    mart: str = "refresh"  # or "upsert"

    @property
    def home(self) -> str:
        return self.warehouse.rstrip("/")

    @property
    def run_id(self) -> str:
        return self.run_at.strftime("%Y%m%dT%H%M%S%f")


def _by_month(fact: DataFrame) -> DataFrame:
    """Partition columns from the calendar key; rows outside the calendar share the null partition."""
    key = F.col("date_id")
    return fact.withColumns({"order_year": F.floor(key / 10000), "order_month": F.floor(key / 100) % 100})


def load_star(
    sources: Mapping[str, DataFrame],
    calendar: DataFrame,
    path: str,
    as_of: str | dt.date = AS_OF,
    price_bands: Bands = PRICE_BANDS,
    order: Order = None,
) -> dict[str, DataFrame]:
    """Build and write all seven tables under ``path``; returns them as read back.

    Tables carry their declared types and comments; facts are sorted by day
    inside each file. ``order`` says which of several rows of a key is kept.

    The line-item fact is built on the order fact already written, so the joins
    behind the order fact run once. Large facts are built and written in slices of
    their keys, and each write removes its shuffles: what lies on disk beside the
    star is a part of what the facts shuffle in all. Orders, which shuffle
    less and come first, are cut into a quarter as many slices as lines.
    """
    spark = calendar.sparkSession

    def store(name: str, *parts: DataFrame) -> DataFrame:
        target = f"{path}/{name}"
        for position, part in enumerate(parts):
            frame, mode = conform(part, STAR[name]), "append" if position else "overwrite"
            if name.startswith("fact_"):
                frame = _by_month(frame)
                publish(frame, target, mode, partition_by=FACT_PARTITIONS, sort_by=("date_id",), compression="zstd")
            else:
                publish(frame, target, mode)
        return spark.read.schema(frame.schema).parquet(target).select(*STAR[name].columns)

    orders, payments, lines = sources["orders"], sources["payments"], sources["order_items"]
    number = slice_count(orders, payments, lines)
    first = {
        "fact_orders": [
            order_fact(orders.filter(some), payments.filter(some), calendar, order)
            for some in slices("order_id", (number + 3) // 4)
        ],
        "dim_date": [calendar],
        "dim_customer": [customer_dim(sources["customers"], as_of, order)],
        "dim_restaurant": [restaurant_dim(sources["restaurants"], order=order)],
        "dim_menu_item": [menu_item_dim(sources["menu_items"], price_bands, order)],
        "dim_delivery_agent": [agent_dim(sources["delivery_agents"], as_of, order=order)],
    }
    with shuffles_removed(spark):
        # These writes do not depend on each other, so small ones fill the gaps of the large one.
        with ThreadPoolExecutor(len(first)) as pool:
            pending = {name: pool.submit(inheritable_thread_target(spark)(store), name, *parts) for name, parts in first.items()}
            written = {name: done.result() for name, done in pending.items()}
        owners = written["fact_orders"]
        items = [order_item_fact(lines.filter(some), owners, order) for some in slices("order_item_id", number)]
        written["fact_order_items"] = store("fact_order_items", *items)
    return {name: written[name] for name in STAR}


def read_star(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}").select(*table.columns) for name, table in STAR.items()}


def read_fact_range(spark: SparkSession, path: str, name: str, first_key: int, last_key: int) -> DataFrame:
    """Rows of a written fact for an inclusive range of calendar keys.

    Months outside the range are pruned as partitions, days by file statistics.
    """
    month = F.col("order_year") * 100 + F.col("order_month")
    return (
        spark.read.parquet(f"{path}/{name}")
        .filter(month.between(first_key // 100, last_key // 100) & F.col("date_id").between(first_key, last_key))
        .select(*STAR[name].columns)
    )


def audit_star(star: Mapping[str, DataFrame]) -> None:
    """Refuse a star with repeated keys. Orphans and nulls are findings (``quality.findings``), not failures."""
    broken = quality.key_audit(star).filter(F.col("repeated_keys") > 0).orderBy("table_name").collect()
    if broken:
        raise AuditFailed("; ".join(f"{r.table_name}({r.key_columns}): {r.repeated_keys} repeated" for r in broken))


def current_star(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The star of the last run that passed its audits."""
    runs = spark.read.parquet(f"{warehouse.rstrip('/')}/runs")
    last = runs.orderBy(F.desc("run_at"), F.desc("run_id")).first()
    return read_star(spark, f"{warehouse.rstrip('/')}/star/{last.run_id}")


def _order_days(orders: DataFrame, settings: Settings) -> tuple[str, str]:
    """First and last day of the calendar: as set, else those of the orders."""
    if settings.calendar_start and settings.calendar_end:
        return settings.calendar_start, settings.calendar_end
    day = F.to_date(F.to_timestamp_ntz(F.col("order_timestamp")))
    first, last = orders.agg(F.min(day), F.max(day)).first()
    if first is None:
        raise ValueError("no order has a day; set calendar_start and calendar_end")
    return settings.calendar_start or str(first), settings.calendar_end or str(last)


def _build(spark: SparkSession, settings: Settings, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The star of the sources, audited, and what the audits have found."""
    first, last = _order_days(sources["orders"], settings)
    calendar = calendar_dim(spark, first, last, settings.holidays, settings.peak_months)
    star = load_star(
        sources, calendar, f"{settings.home}/star/{settings.run_id}", settings.as_of, settings.price_bands,
        order=[INGEST],
    )
    audit_star(star)
    declared = {name: frame.drop(INGEST) for name, frame in sources.items()}
    publish_version(
        quality.findings(declared, star), f"{settings.home}/{FINDINGS.name}", settings.run_id, keep=settings.keep_runs
    )
    return star


def run_load(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """Gate the sources, load the star, audit it and make it current.

    A star is written to a folder of its own and becomes current by one row
    appended to ``runs``, so readers never see a half-written table. A text source is
    parsed once: its rows are counted while a typed copy is written, which all that
    follows reads. A row that does not fit its schema fails the run, or with
    ``quarantine`` is written per run with the reasons (``quarantined_rows``) and left
    out. Of several rows of a key the first in the files is kept. What the profiles and
    constraints find is written per run; the last ``keep_runs`` stars and findings stay.
    """
    text = settings.source_format == "csv"
    sources = read_present(
        spark, settings.source_root, settings.source_format, strict=not settings.quarantine,
        multi_line=settings.multi_line, ingest=True,
    )
    copies = scratch_path(spark, "staged")
    try:
        if text:
            staged = stage(spark, sources, copies)
            sources = staged.frames
            gate = quality.counted_gate(spark, staged.counts, settings.minimums)
        else:
            gate = quality.source_gate(spark, sources, settings.minimums)
        quality.require_gate(gate)
        if text and settings.quarantine:
            publish_version(
                staged.quarantined, f"{settings.home}/{QUARANTINE.name}", settings.run_id, keep=settings.keep_runs
            )
        star = _build(spark, settings, sources)
    finally:
        remove_path(spark, copies)
    run = spark.range(1).select(
        F.lit(settings.run_id).alias("run_id"), as_timestamp(settings.run_at).alias("run_at")
    )
    publish(run, f"{settings.home}/runs", mode="append")
    done = {r.run_id for r in spark.read.parquet(f"{settings.home}/runs").select("run_id").distinct().collect()}
    kept = sorted(done)[-settings.keep_runs:]  # stars of runs that failed do not count
    for old in child_names(spark, f"{settings.home}/star"):
        if old not in kept:
            remove_path(spark, f"{settings.home}/star/{old}")
    return star


def run_mart(spark: SparkSession, settings: Settings) -> None:
    """Replace the monthly mart from the current star, or upsert its months."""
    star = current_star(spark, settings.home)
    if settings.mart == "upsert":
        marts.upsert_mart(
            f"{settings.home}/{MONTHLY_MART.name}_upserted", settings.run_id,
            star["fact_orders"], star["dim_date"], star["dim_restaurant"], keep=settings.keep_runs,
        )
        return
    marts.refresh_mart(
        f"{settings.home}/{MONTHLY_MART.name}", settings.run_id,
        star["fact_orders"], star["dim_date"], star["dim_restaurant"],
    )


def run_forecast(spark: SparkSession, settings: Settings) -> None:
    """Write the forecasts of the current star, of all orders and by city and cuisine, as new versions,
    and the error measures of the former under the run's name.

    A retry of a run replaces what the run has written, so nothing is counted twice.
    """
    star = current_star(spark, settings.home)
    series = fc.daily_series(star["fact_orders"], star["dim_date"])
    predicted = fc.fit_and_predict(series, settings.horizon)
    metrics = fc.error_metrics(fc.observed(predicted), predicted)
    forecast = conform(fc.future_only(predicted, settings.run_at), FORECAST)
    publish_version(forecast, f"{settings.home}/{FORECAST.name}", settings.run_id, keep=settings.keep_runs)
    publish(fc.stamped(metrics, settings.run_at), f"{settings.home}/{METRICS.name}/run={settings.run_id}")
    grouped = gf.fit_and_predict_by(
        gf.daily_series_by(star["fact_orders"], star["dim_date"], star["dim_restaurant"]), horizon=settings.horizon
    )
    publish_version(
        conform(gf.future_by(grouped, settings.run_at), GROUP_FORECAST), f"{settings.home}/{GROUP_FORECAST.name}",
        settings.run_id, keep=settings.keep_runs,
    )


def run_daily(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """Load, refresh the mart, forecast: the whole chain, for any scheduler to call."""
    star = run_load(spark, settings)
    run_mart(spark, settings)
    run_forecast(spark, settings)
    return star
