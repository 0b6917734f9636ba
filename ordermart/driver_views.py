"""The raw sources of this engine, derived from the order tables at hand.

The tables ``orders lineitem customer supplier part nation region`` hold no
deliveries, so the missing columns are integer arithmetic on the keys. Names
are padded and lower-cased, so that the cleaning steps have work to do.
Merchants and couriers are both taken from ``supplier``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.functions.bands import Bands
from ordermart.operators.slices import slice_count, slices
from ordermart.plans.calendar import calendar_of
from ordermart.plans.job import load_star
from ordermart.plans.star import derive_payments
from ordermart.schemas import SOURCES
from ordermart.session import remove_path, scratch_path, shuffles_removed

# Fixed values of the mapping; the SQL texts in oracle.py repeat them.
AS_OF = "2001-08-01"
FIRST_DAY = "1995-01-01"
SPAN_DAYS = 2404
PRICE_BANDS = Bands((0, 920, 940, 980, float("inf")), ("Budget", "Affordable", "Mid-Range", "Premium"))
STATUS = {"F": "Delivered", "O": "Cancelled", "P": "Refunded"}
PLATFORM = {"1": "App-iOS", "2": "App-iOS", "3": "App-Android", "4": "App-Android", "5": "Web"}
LINES_PER_ORDER = 1 << 24
AGES = ("18-24", "25-34", "35-44", "45-54", "55+")
VEHICLES = ("Bike", "Scooter", "Bicycle")
METHODS = ("UPI", "Card", "Cash", "Wallet", "Net Banking")
HOLIDAYS = tuple(f"{year}-{day}" for year in range(1995, 2002) for day in ("01-26", "08-15", "10-02"))


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _mapped(column, mapping):
    first, *rest = mapping.items()
    chain = F.when(column == first[0], first[1])
    for key, value in rest:
        chain = chain.when(column == key, value)
    return chain


def _amount(whole_cents):
    return whole_cents.cast("decimal(15,0)") * F.lit(Decimal("0.01"))


def _day(key, step: int):
    return F.date_add(F.lit(FIRST_DAY).cast("date"), ((key * step) % SPAN_DAYS).cast("int"))


def _dirty(name):
    return F.concat(F.lit(" \t"), F.lower(name), F.lit("\n "))


def _by_line(lines: DataFrame):
    others = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    return Window.partitionBy("l_orderkey").orderBy("l_linenumber", *others)


def line_id(lines: DataFrame):
    """One number per distinct line: line numbers repeat within an order, so lines are ranked by all columns."""
    return F.col("l_orderkey") * F.lit(LINES_PER_ORDER).cast("bigint") + F.dense_rank().over(_by_line(lines))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """The lines with their number and their paid cents; ``l_first`` holds for one of several equal lines.

    It is known from the order in which lines are numbered: the payments need no sort or shuffle of their own.
    """
    # Prices have two decimals: whole cents first, as casting doubles to decimals is slow.
    paid = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    place = _by_line(lines)
    return lines.select(
        "l_orderkey", line_id(lines).alias("l_id"), "l_partkey", F.col("l_quantity").cast("int").alias("l_quantity"),
        paid.alias("l_paid"), (F.row_number().over(place) == F.rank().over(place)).alias("l_first"),
    )


def _unit_cents():
    return F.call_function("div", F.col("l_paid") * 2 + F.col("l_quantity"), F.col("l_quantity") * 2)


def raw_sources(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven raw sources as lazy frames over the given tables, and over a copy of the ``numbered_lines`` where there is one."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    nation, region, lines = table("nation"), table("region"), table("lineitem")

    c = F.col("c_custkey")
    customers = table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        c.alias("customer_id"),
        _dirty(F.col("c_name")).alias("full_name"),
        F.concat(F.lit(" "), F.upper(F.translate("c_name", "#", ".")), F.lit("@MAIL.COM\t")).alias("email"),
        F.when(c % 11 != 0, (F.lit(9000000000) + c).cast("string")).alias("phone"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("city"),
        _day(c, 37).cast("string").alias("registration_date"),
        _pick(AGES, c % 5).alias("age_group"),
        F.when(c % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(c % 97 != 0, F.col("c_acctbal") >= 5000).alias("is_premium"),
    )

    s = F.col("s_suppkey")
    suppliers = table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    restaurants = suppliers.select(
        s.alias("restaurant_id"),
        _dirty(F.col("s_name")).alias("name"),
        F.concat(F.col("n_name"), F.lit("  ")).alias("city"),
        F.col("r_name").alias("cuisine_type"),
        ((F.lit(25) + (s * 7) % 26) / F.lit(10)).cast("decimal(3,1)").alias("rating"),
        ((s * 13) % 5000).cast("int").alias("total_reviews"),
        (F.lit(10) + s % 40).cast("int").alias("avg_prep_time_min"),
        (s % 4 == 0).alias("is_veg_only"),
        _day(s, 41).cast("string").alias("onboarded_date"),
    )
    agents = suppliers.select(
        s.alias("agent_id"),
        _dirty(F.translate("s_name", "#", "-")).alias("name"),
        F.col("n_name").alias("city"),
        _pick(VEHICLES, s % 3).alias("vehicle"),
        ((F.lit(30) + (s * 3) % 21) / F.lit(10)).cast("decimal(3,1)").alias("rating"),
        _day(s, 53).cast("string").alias("joined_date"),
    )

    p = F.col("p_partkey")
    seller = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_suppkey").alias("restaurant_id"))
    menu_items = table("part").join(seller, "p_partkey", "left").select(
        p.alias("item_id"),
        "restaurant_id",
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(8,2)").alias("price"),
        (p % 9 != 0).alias("is_available"),
        (p % 2 == 0).alias("is_veg"),
        (F.lit(100) + p % 900).cast("int").alias("calories"),
    )

    order_items = (numbered_lines(lines) if numbered is None else numbered).select(
        F.col("l_id").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        _amount(_unit_cents()).alias("unit_price"),
        _amount(F.col("l_paid")).alias("line_total"),
        "l_first",
    )

    o = F.col("o_orderkey")
    served = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("restaurant_id"), F.max("l_suppkey").alias("agent_id")
    )
    orders_full = table("orders").join(served, "o_orderkey", "left").select(
        o.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        "restaurant_id",
        "agent_id",
        F.timestamp_add("HOUR", (o % 24).cast("int"), "o_orderdate").alias("order_timestamp"),
        (F.lit(20) + o % 55).cast("int").alias("delivery_time_min"),
        ((F.lit(50) + o % 1450) / F.lit(100)).cast("decimal(5,2)").alias("distance_km"),
        _mapped(F.col("o_orderstatus"), STATUS).alias("status"),
        ((o % 6) * 5).cast("int").alias("discount_pct"),
        _mapped(F.substring("o_orderpriority", 1, 1), PLATFORM).alias("platform"),
        _amount(F.lit(2000) + o % 4001).alias("delivery_fee"),
        _pick(METHODS, o % 5).alias("method"),
    )
    unique_items = _text_ids(order_items.filter("l_first").drop("l_first"))
    return {
        "customers": _declared("customers", customers),
        "restaurants": _declared("restaurants", restaurants),
        "menu_items": _declared("menu_items", menu_items),
        "delivery_agents": _declared("delivery_agents", agents),
        "orders": _declared("orders", orders_full.drop("delivery_fee", "method")),
        "order_items": _declared("order_items", order_items),
        "payments": derive_payments(_text_ids(orders_full), unique_items),
    }


def _text_ids(frame: DataFrame) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("string") for c in frame.columns if c.endswith("_id")})


def _declared(name: str, frame: DataFrame) -> DataFrame:
    """Identifiers as text, as the sources declare them."""
    return _text_ids(frame).select(*SOURCES[name].columns)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of the orders, whose hour is added to a day of its own."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    bounds = orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.to_date(F.timestamp_add("HOUR", F.lit(23), F.max("o_orderdate"))).alias("last_day"),
    )
    return calendar_of(bounds, HOLIDAYS)


def copy_numbered(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The ``numbered_lines`` written to ``path`` in slices of orders, so that both facts are built on lines numbered once."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    with shuffles_removed(spark):
        for some in slices("l_orderkey", slice_count(lines, most=2)):
            part = numbered_lines(lines.filter(some))
            part.write.mode("append").parquet(path, compression="zstd")
    return spark.read.schema(part.schema).parquet(path)


_loaded: dict[tuple[str, str], tuple[str, dict[str, DataFrame]]] = {}


def _load(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _loaded:
        path, copy = scratch_path(spark, "star"), scratch_path(spark, "lines")
        try:
            raw = raw_sources(spark, sf_dir, copy_numbered(spark, sf_dir, copy))
            tables = load_star(raw, calendar(spark, sf_dir), path, as_of=AS_OF, price_bands=PRICE_BANDS)
        finally:
            remove_path(spark, copy.rpartition("/")[0])
        _loaded[slot] = (path, tables)
    return _loaded[slot]


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star of ``sf_dir``, loaded once per application into the shared folder."""
    return _load(spark, sf_dir)[1]


def star_path(spark: SparkSession, sf_dir: str) -> str:
    """Where that star was written."""
    return _load(spark, sf_dir)[0]
