"""Benchmark: star load, reports, mart, segments and forecast; prints one JSON line.

Each figure is the median wall time of three runs after one warm-up run, plan
building included. Reports read the loaded star, as the reports of a warehouse
do; the load itself is timed as ``star_build``.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ordermart import driver_views as dv
from ordermart import registry
from ordermart.session import build_session, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

REPORTS = [
    "monthly_revenue_trend", "monthly_revenue_trend_rounded", "monthly_trend_delivered", "yearly_revenue",
    "top_restaurants", "top_items", "cancellation_by_segment", "hourly_demand", "demand_heatmap",
    "agent_performance", "deliveries_by_tier_box", "platform_split", "kpi_strip", "status_distribution",
    "segment_counts", "customer_lifetime_value", "clv_top20", "rfm_segments", "rfm_customers",
    "monthly_mart_refresh", "monthly_mart_upsert", "fk_orphans", "pk_audit", "null_profile",
    "dedup_keep_first", "order_fact", "forecast_daily", "forecast_metrics",
]


def median_of(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def load() -> None:
        dv.load_star(
            dv.raw_sources(spark, SF_DIR), dv.calendar(spark, SF_DIR), scratch_path(spark, "star"),
            as_of=dv.AS_OF, price_bands=dv.PRICE_BANDS,
        )

    timings = {"star_build": median_of(load)}
    for name in REPORTS:
        timings[name] = median_of(
            lambda: queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
