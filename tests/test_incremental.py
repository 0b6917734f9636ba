"""Refresh of changed months and sketches by month, against the full computation."""

from test_reports import calendar, make_orders  # noqa: F401

from pyspark.sql import functions as F

from ordermart.operators.versioned import manifest
from ordermart.plans import incremental, marts
from ordermart.schemas import MONTHLY_MART
from ordermart.sources.writers import conform


def line(n, day, net="10.00", status="Delivered", minutes=30):
    return (f"O{n}", f"C{n % 7}", f"R{n % 3}", "A1", day, 12, status, minutes, net)


def test_only_changed_months_are_written_and_all_is_equal_to_a_full_refresh(spark, calendar, tmp_path):  # noqa: F811
    shops = spark.createDataFrame([("R0", "Rome", "Thai"), ("R1", "Oslo", "Thai"), ("R2", None, "Thai")], "restaurant_id string, city string, cuisine_type string")
    first = [line(1, "2023-01-02"), line(2, "2023-02-03"), line(2, "2023-02-03"), line(3, "2023-03-06"), line(4, "2023-04-01"), line(5, None)]
    loads = [
        (first, shops, [(2023, 1), (2023, 2), (2023, 3), (2023, 4)]),
        (list(reversed(first)), shops, []),  # another order of the rows is no change
        ([line(1, "2023-01-02", "11.00"), *first[1:2], *first[3:4], line(6, "2023-05-05"), line(5, None)], shops,
         [(2023, 1), (2023, 2), (2023, 4), (2023, 5)]),  # changed, one of two equal rows gone, month gone, late
        (first[1:2], shops.withColumn("city", F.lit("Bern")), [(2023, 1), (2023, 2), (2023, 3), (2023, 5)]),
        ([], shops, [(2023, 2)]),
    ]
    root, before = str(tmp_path / "mart"), {}
    for number, (lines, merchants, expected) in enumerate(loads, 1):
        orders = make_orders(spark, lines) if lines else make_orders(spark, first).limit(0)
        assert incremental.refresh_changed(root, str(number), orders, calendar, merchants) == expected
        full = conform(marts.mart_for_refresh(orders, calendar, merchants), MONTHLY_MART)
        found = incremental.refreshed_mart(spark, root)
        assert sorted(map(repr, found.select(*full.columns).collect())) == sorted(map(repr, full.collect()))
        held = manifest(spark, root)
        kept = {p for p, v in held.items() if v != str(number)}
        assert all(before[p] == held[p] for p in kept) and len(held) - len(kept) <= len(expected)
        before = held


def test_sketches_of_months_merge_within_their_bounds(spark, calendar):  # noqa: F811
    base = make_orders(spark, [line(1, "2023-01-02")])
    many = base.drop("customer_id", "restaurant_id", "date_id", "delivery_time_min").crossJoin(spark.range(60_000)).selectExpr(
        "*", "concat('C', pmod(xxhash64(id), 20000)) as customer_id", "if(id % 10 = 0, null, concat('R', id % 90)) as restaurant_id",
        "cast(20230000 + (1 + id % 12) * 100 + 1 + id % 28 as int) as date_id", "cast(pmod(xxhash64(id, 1), 5000) as int) as delivery_time_min",
    ).drop("id")
    found = incremental.span_check(many, calendar).collect()
    assert [tuple(r)[4:] for r in found] == [(True, True, True)] and found[0].total_orders == 60_000
    figures = incremental.span_figures(incremental.monthly_state(many, calendar).filter("month <= 6")).first()
    half = many.filter("date_id < 20230700")
    assert abs(figures.customers / half.select("customer_id").distinct().count() - 1) < 3 * incremental.HLL_ERROR
    empty = make_orders(spark, [line(1, "2023-01-02", status="Cancelled", minutes=None)])
    one = incremental.span_figures(incremental.monthly_state(empty, calendar), "year").first()
    assert (one.customers, one.median_minutes) == (1, None)
    assert incremental.span_figures(incremental.monthly_state(empty.limit(0), calendar), "year").collect() == []
