"""Every registered query against its SQL text, on the smallest tables."""

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as driver
from check_queries import TABLES, rows_of
from ordermart import driver_views as dv
from ordermart import oracle, registry
from ordermart.plans import reports
from ordermart.plans.job import read_fact_range

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = driver.queries()[name](spark, SF)
    result = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, result.fetchall())


def test_every_query_of_the_warehouse_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def scan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_a_report_needs(spark):
    star = dv.star(spark, SF)
    plan = scan_of(reports.platform_split_by_flag(star["fact_orders"]))
    assert "EqualTo(is_delivered,1)" in plan
    assert "ReadSchema: struct<platform:string,is_delivered:smallint,net_total:decimal(10,2)>" in plan
    assert "GreaterThanOrEqual(date_id,19960101)" in scan_of(reports.orders_between(star["fact_orders"], 19960101, 19961231))


def test_facts_are_summed_before_the_dimension_is_joined(spark):
    star = dv.star(spark, SF)
    for report, dimension in ((reports.top_restaurants, "dim_restaurant"), (reports.agent_performance, "dim_delivery_agent"),
                              (reports.monthly_revenue_trend, "dim_date"), (reports.yearly_revenue, "dim_date")):
        plan = scan_of(report(star["fact_orders"], star[dimension]))
        fact = plan[:plan.index("ReadSchema")]  # from the root down to the fact scan
        # lines further down are nearer to the scan: partial sums, then the shuffle, and only then the join
        assert fact.rindex("Join") < fact.rindex("Exchange hashpartitioning") < fact.rindex("partial_sum")


def test_range_of_days_prunes_months(spark):
    fact = read_fact_range(spark, dv.star_path(spark, SF), "fact_orders", 19960115, 19960210)
    assert len(fact.columns) == 20
    assert sorted(r[0] for r in fact.select("date_id").distinct().collect())[0] >= 19960115
    plan = scan_of(fact)
    kept = plan[plan.index("PartitionFilters: ["):plan.index("PushedFilters")]
    assert "order_year" in kept and "order_month" in kept
    whole = sorted(tuple(r) for r in dv.star(spark, SF)["fact_orders"].filter("date_id between 19960115 and 19960210").select("order_id").collect())
    assert sorted(tuple(r) for r in fact.select("order_id").collect()) == whole


def test_star_is_loaded_once(spark):
    assert dv.star(spark, SF) is dv.star(spark, SF)


def test_sums_of_parts(spark):
    star = dv.star(spark, SF)
    orders = star["fact_orders"]
    assert orders.count() == orders.select("order_id").distinct().count()
    assert sum(r.orders for r in reports.status_distribution(orders).collect()) == orders.count()
    assert sum(r.cnt for r in reports.segment_counts(star["dim_customer"]).collect()) == star["dim_customer"].count()
    # A customer whose premium flag is unknown has no segment.
    assert rows(reports.segment_counts(star["dim_customer"]).select("customer_segment")) == [
        ("Premium-Loyal",), ("Premium-New",), ("Regular-Loyal",), ("Regular-New",), (None,)
    ]
