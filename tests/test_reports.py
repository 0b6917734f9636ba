import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from ordermart.plans import marts, reports, segments
from ordermart.plans.calendar import calendar_dim

D = Decimal


@pytest.fixture(scope="module")
def calendar(spark):
    return calendar_dim(spark, "2023-01-01", "2023-12-31").cache()


def make_orders(spark, lines):
    """(order, customer, restaurant, agent, day or None, hour, status, minutes, net)"""
    full = []
    for o, c, r, a, day, hour, status, minutes, net in lines:
        when = dt.datetime.combine(dt.date.fromisoformat(day or "2030-01-01"), dt.time(hour))
        full.append((o, c, r, a, int(day.replace("-", "")) if day else None, when, hour, "Web", status,
                     int(status == "Delivered"), int(status == "Cancelled"), minutes, D(net), D(net)))
    return spark.createDataFrame(
        full,
        "order_id string, customer_id string, restaurant_id string, agent_id string, date_id int,"
        " order_timestamp timestamp_ntz, order_hour int, platform string, status string, is_delivered int,"
        " is_cancelled int, delivery_time_min int, gross_total decimal(18,2), net_total decimal(18,2)",
    )


@pytest.fixture
def orders(spark):
    return make_orders(spark, [
        ("O1", "C1", "R1", "A1", "2023-01-02", 12, "Delivered", 30, "100.00"),
        ("O2", "C1", "R1", "A1", "2023-01-03", 12, "Refunded", 41, "50.00"),
        ("O3", "C2", "R2", "A2", "2023-01-03", 9, "Cancelled", 20, "0.00"),
        ("O4", "C2", "R2", "A1", "2023-03-06", 12, "Delivered", None, "300.01"),  # no order in February
        ("O5", "C3", "R1", "A1", "2023-04-01", 1, "CANCELLED", 10, "7.00"),
        ("O6", "C3", "R1", "A1", "2023-04-02", 1, "Refunded", 10, "0.00"),
        ("O7", "C3", "R1", "A1", "2023-05-02", 1, "delivered", 10, "9.00"),
        ("O8", "C4", "R1", "A1", None, 1, "Delivered", 10, "1000.00"),  # day outside the calendar
    ])


def test_monthly_revenue_trend(orders, calendar):
    found = reports.monthly_revenue_trend(orders, calendar).collect()
    assert [tuple(r) for r in found] == [
        (2023, 1, "January", D("150.00"), 2, 1, D("150.00"), None),
        (2023, 3, "March", D("300.01"), 1, 1, D("300.01"), D("100.01")),  # against January: the row before
        (2023, 4, "April", D("0.00"), 1, 0, None, D("-100.00")),
        (2023, 5, "May", D("9.00"), 1, 0, None, None),  # nothing to grow from
    ]


def test_rounded_trend_matches_status_by_case(orders, calendar):
    found = rows(reports.monthly_revenue_trend_rounded(orders, calendar).select("date_str", "net_revenue", "prev_revenue", "mom_growth_pct"), "date_str")
    assert found[2] == ("2023-04", D("7.00"), D("300.01"), D("-97.67"))
    assert [r[0] for r in found] == ["2023-01", "2023-03", "2023-04", "2023-05"]
    assert [r[0] for r in rows(reports.monthly_growth(orders, calendar), "date_str")] == ["2023-03", "2023-04", "2023-05"]


def test_null_status_is_neither_kept_nor_cancelled(spark, calendar):
    orders = make_orders(spark, [
        ("O1", "C1", "R1", "A1", "2023-01-02", 1, None, 10, "5.00"), ("O2", "C1", "R1", "A1", "2023-01-02", 1, "Delivered", 10, "7.00"),
    ])
    assert reports.monthly_revenue_trend(orders, calendar).first().net_revenue_inr == D("7.00")
    assert {tuple(r)[:2] for r in reports.status_distribution(orders).collect()} == {(None, 1), ("Delivered", 1)}
    assert reports.kpi_strip(orders).first().total_orders == 2


def test_case_decides_which_orders_count(orders, calendar):
    assert rows(reports.yearly_revenue(orders, calendar)) == [(2023, D("409.01"))]  # status text, any case
    delivered = rows(reports.monthly_trend_delivered(orders, calendar).select("date_str", "orders"), "date_str")
    assert delivered == [("2023-01", 1), ("2023-03", 1)]  # by flag
    assert rows(reports.platform_split(orders)) == [("Web", 4, D("1409.01"))]
    assert rows(reports.platform_split_by_flag(orders)) == [("Web", 3, D("1400.01"))]


def test_kpis(spark, orders):
    found = reports.kpi_strip(orders).first().asDict()
    assert found == {
        "total_orders": 8, "delivered": 3, "cancelled": 1, "net_revenue": D("1400.01"), "avg_order_value": D("466.67"),
        "avg_delivery_min": D("20.0"), "unique_customers": 4, "unique_restaurants": 2, "delivery_rate_pct": D("37.5"),
    }
    empty = reports.kpi_strip(orders.filter("false")).first()
    assert empty.total_orders == 0 and empty.delivery_rate_pct is None and empty.avg_order_value is None


def test_shares_add_up(orders):
    found = reports.status_distribution(orders).collect()
    assert sum(r.orders for r in found) == 8
    assert abs(sum(r.share_pct for r in found) - 100) < D("0.05")


def test_demand(orders, calendar):
    assert rows(reports.hourly_demand(orders, calendar)) == [
        ("Monday", 12, 2, D("400.01")), ("Tuesday", 1, 1, D("9.00"))
    ]
    grid = reports.demand_heatmap(orders, calendar).collect()
    assert [r.day_name for r in grid] == list(reports.WEEK)
    assert grid[0].h12 == 2.0 and grid[1].h1 == 1.0
    assert sum(r[f"h{h}"] for r in grid for h in range(24)) == 3.0


def test_merchants_and_couriers(spark, orders):
    shops = spark.createDataFrame([("R1", "One", "Pune", "Thai", 4.0), ("R2", "Two", "Goa", "Thai", 3.0)],
                                  "restaurant_id string, name string, city string, cuisine_type string, rating double")
    best = reports.top_restaurants(orders, shops, limit=1).collect()
    assert [(r.restaurant_id, r.total_orders, r.net_revenue, r.avg_delivery_min, r.delivery_success_rate) for r in best] == [
        ("R1", 6, D("1166.00"), D("18.5"), D("33.33"))
    ]
    agents = spark.createDataFrame([("A1", "Ann", "Pune", "Bike", "Good"), ("A2", "Bob", "Goa", "Bike", "Good"), ("A3", "Idle", "Goa", "Bike", "Good")],
                                   "agent_id string, name string, city string, vehicle string, performance_tier string")
    assert rows(reports.agent_performance(orders, agents).select("agent_id", "deliveries")) == [("A1", 7), ("A2", 1)]
    assert [r.agent_id for r in reports.agent_leaderboard(orders, agents, limit=1).collect()] == ["A1"]
    box = reports.deliveries_by_tier_box(orders, agents).first()
    assert (box.agents, box.min_deliveries, box.q1, box.median, box.q3, box.max_deliveries) == (2, 1.0, 2.5, 4.0, 5.5, 7.0)
    assert (box.lower_fence, box.upper_fence) == (-2.0, 10.0)


def test_groups_of_99_and_100_orders(spark):
    orders = make_orders(spark, [
        (f"{r}{i}", "C", r, "A", "2023-01-02", 1, "Cancelled" if i < 25 else "Delivered", 10, "1.00")
        for r, n in (("R1", 99), ("R2", 60), ("R3", 40)) for i in range(n)
    ])
    shops = spark.createDataFrame([("R1", "Pune", "Thai"), ("R2", "Goa", "Thai"), ("R3", "Goa", "Thai")],
                                  "restaurant_id string, city string, cuisine_type string")
    assert rows(reports.cancellation_by_segment(orders, shops)) == [("Goa", "Thai", 100, 50, D("50.00"), D("10.0"))]


def test_top_items_counts_distinct_orders(spark):
    items = spark.createDataFrame(
        [("L1", "O1", "I1", 2, D("5.00"), D("10.00")), ("L2", "O1", "I1", 1, D("6.00"), D("6.00")),
         ("L3", "O2", "I1", 1, D("5.00"), D("5.00")), ("L4", "O2", "I2", 1, D("21.00"), D("21.00")),
         ("L5", "O2", "I3", 9, D("99.00"), D("891.00"))],
        "order_item_id string, order_id string, item_id string, quantity int, unit_price decimal(18,2), revenue decimal(18,2)",
    )
    menu = spark.createDataFrame([("I1", "R1", "Soup", "S"), ("I2", "R1", "Pie", "M"), ("I3", None, "Lost", "M")],
                                 "item_id string, restaurant_id string, item_name string, category string")
    shops = spark.createDataFrame([("R1", "Thai")], "restaurant_id string, cuisine_type string")
    found = [tuple(r) for r in reports.top_items(items, menu, shops).collect()]
    assert found == [  # equal revenue: the lower key first
        ("I1", "Soup", "S", "Thai", 4, 2, D("21.00"), D("5.33")), ("I2", "Pie", "M", "Thai", 1, 1, D("21.00"), D("21.00"))
    ]


def people(spark, ids):
    return spark.createDataFrame([(i, f"N {i}", "Pune", "Regular-New") for i in ids],
                                 "customer_id string, full_name string, city string, customer_segment string")


def test_lifetime_value(spark, orders):
    found = segments.customer_lifetime_value(people(spark, ["C1", "C2", "C3", "C9"]), orders, "2023-06-01").collect()
    # C9 never ordered, C4 is no known customer, only delivered orders count
    assert [(r.customer_id, r.total_orders, r.lifetime_value, r.clv_quartile, r.clv_tier) for r in found] == [
        ("C2", 1, D("300.01"), 1, "Champion"), ("C1", 1, D("100.00"), 2, "Loyal"), ("C3", 1, D("9.00"), 3, "At-Risk")
    ]
    assert found[0].last_order_date == dt.date(2023, 3, 6) and found[0].days_since_last_order == 87
    assert [r.customer_id for r in segments.clv_top(people(spark, ["C1", "C2", "C3"]), orders, 2).collect()] == ["C2", "C1"]


def test_rfm(spark):
    ids = [f"C{i:02d}" for i in range(10)]
    lines = [
        (f"{c}-{n}", c, "R", "A", f"2023-0{1 + i // 2}-1{i % 2}", 1, "Delivered", 10, f"{10 * (i + 1)}.00")
        for i, c in enumerate(ids) for n in range(i + 1)
    ]
    customers = people(spark, ids)
    orders = make_orders(spark, lines)
    scored = rows(segments.rfm_customers(customers, orders, "2023-12-31").select(
        "customer_id", "frequency", "r_score", "f_score", "m_score", "rfm_segment"), "customer_id")
    assert scored[0] == ("C00", 1, 1, 1, 1, "Lost")
    assert scored[9] == ("C09", 10, 5, 5, 5, "Champions")
    assert scored[5] == ("C05", 6, 3, 3, 3, "Loyal Customers")
    found = segments.rfm_segments(customers, orders, "2023-12-31").collect()
    assert sum(r.customer_count for r in found) == 10
    assert [r.rfm_segment for r in found] == ["Champions", "Loyal Customers", "Lost"]
    assert len(segments.rfm_segments_brief(customers, orders, "2023-12-31").columns) == 6


@pytest.mark.parametrize(
    "scores, label",
    [((4, 4, 4), "Champions"), ((3, 3, 3), "Loyal Customers"), ((5, 1, 2), "New Customers"), ((3, 3, 2), "Potential Loyalists"),
     ((4, 4, 1), "Recent Customers"), ((1, 5, 4), "At-Risk Customers"), ((2, 3, 3), "About to Sleep"), ((2, 2, 1), "Lost"),
     ((3, 1, 5), "Can't Lose Them"), ((1, 1, 5), "Others"), ((3, 1, 1), "Others")],
)
def test_rfm_rules(spark, scores, label):
    frame = spark.createDataFrame([scores], "r_score int, f_score int, m_score int")
    assert frame.select(segments._rfm_label()).first()[0] == label


def test_marts_differ_in_their_averages(spark, orders, calendar, tmp_path):
    shops = spark.createDataFrame([("R1", "Pune", "Thai"), ("R2", "Goa", "Thai")], "restaurant_id string, city string, cuisine_type string")
    refresh = marts.mart_for_refresh(orders, calendar, shops)
    every = marts.mart_for_upsert(orders, calendar, shops)
    january = (refresh.month == 1) & (refresh.city == "Pune")
    assert (refresh.filter(january).first().avg_order_value, refresh.filter(january).first().avg_delivery_min) == (D("100.00"), D("30.00"))
    row = every.filter("month = 1 and city = 'Pune'").first()
    assert (row.avg_order_value, row.avg_delivery_min, row.total_orders) == (D("75.00"), D("35.50"), 2)

    root = str(tmp_path / "mart")
    path = marts.refresh_mart(root, "1", orders, calendar, shops)
    once = rows(spark.read.parquet(path))
    path = marts.refresh_mart(root, "2", orders, calendar, shops)
    assert rows(spark.read.parquet(path)) == once
    other = str(tmp_path / "upserted")
    marts.seed_mart(other, "1", orders, calendar, shops)
    marts.upsert_mart(other, "2", orders, calendar, shops)
    columns = marts.MONTHLY_MART.columns
    # same revenue, and nothing else may change
    assert rows(marts.upserted_mart(spark, other)) == rows(spark.read.parquet(path).select(*columns))
