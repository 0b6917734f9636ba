"""Declared shape of every table: types, nullability, keys, lengths, comments."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class Table:
    """A declared table. ``lengths`` holds VARCHAR limits, ``foreign`` column -> parent table."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    foreign: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    comment: str = ""

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _declare(
    name: str,
    key: str | tuple[str, ...],
    columns: str,
    *,
    unique: tuple[str, ...] = (),
    foreign: dict[str, str] | None = None,
    comment: str = "",
    comments: dict[str, str] | None = None,
) -> Table:
    """Build a table from lines ``column type [required]``; ``varchar(n)`` records its length."""
    fields, lengths = [], {}
    for line in columns.strip().splitlines():
        column, kind, *flags = line.split()
        if kind.startswith("varchar("):
            lengths[column] = int(kind[8:-1])
            data_type: T.DataType = T.StringType()
        elif kind.startswith("decimal("):
            precision, scale = kind[8:-1].split(",")
            data_type = T.DecimalType(int(precision), int(scale))
        else:
            data_type = _TYPES[kind]
        metadata = {"comment": comments[column]} if comments and column in comments else {}
        fields.append(T.StructField(column, data_type, "required" not in flags, metadata))
    keys = (key,) if isinstance(key, str) else key
    return Table(name, T.StructType(fields), keys, unique, foreign or {}, lengths, comment)


# ---- raw sources -----------------------------------------------------------

SOURCES = {
    table.name: table
    for table in (
        _declare("customers", "customer_id", """
            customer_id string
            full_name string
            email string
            phone string
            city string
            registration_date date
            age_group string
            gender string
            is_premium boolean"""),
        _declare("restaurants", "restaurant_id", """
            restaurant_id string
            name string
            city string
            cuisine_type string
            rating decimal(3,1)
            total_reviews int
            avg_prep_time_min int
            is_veg_only boolean
            onboarded_date date"""),
        _declare("menu_items", "item_id", """
            item_id string
            restaurant_id string
            item_name string
            category string
            price decimal(8,2)
            is_available boolean
            is_veg boolean
            calories int"""),
        _declare("delivery_agents", "agent_id", """
            agent_id string
            name string
            city string
            vehicle string
            rating decimal(3,1)
            joined_date date"""),
        _declare("orders", "order_id", """
            order_id string
            customer_id string
            restaurant_id string
            agent_id string
            order_timestamp timestamp
            delivery_time_min int
            distance_km decimal(5,2)
            status string
            discount_pct int
            platform string"""),
        _declare("order_items", "order_item_id", """
            order_item_id string
            order_id string
            item_id string
            quantity int
            unit_price decimal(10,2)
            line_total decimal(10,2)"""),
        _declare("payments", "payment_id", """
            payment_id string
            order_id string
            method string
            gross_total decimal(10,2)
            discount_amount decimal(10,2)
            delivery_fee decimal(10,2)
            net_total decimal(10,2)
            status string"""),
    )
}

# Least rows a source must hold to pass the gate.
MINIMUM_ROWS = {
    "customers": 100,
    "restaurants": 10,
    "menu_items": 50,
    "delivery_agents": 10,
    "orders": 500,
    "order_items": 1000,
    "payments": 500,
}

# ---- star ------------------------------------------------------------------

STAR = {
    table.name: table
    for table in (
        _declare("dim_date", "date_id", """
            date_id int required
            full_date date required
            day smallint required
            month smallint required
            month_name varchar(10) required
            quarter smallint required
            year smallint required
            week smallint required
            day_of_week smallint required
            day_name varchar(10) required
            is_weekend boolean required
            is_holiday boolean required
            is_peak_season boolean required""",
            unique=("full_date",),
            comment="One row per calendar day",
            comments={"date_id": "Day as an integer yyyymmdd, for range scans", "day_of_week": "0 is Monday"}),
        _declare("dim_customer", "customer_id", """
            customer_id varchar(10) required
            full_name varchar(100) required
            email varchar(150) required
            phone varchar(20)
            city varchar(50) required
            age_group varchar(10)
            gender varchar(10)
            is_premium boolean required
            registration_date date required
            tenure_days int
            customer_segment varchar(20)""",
            comment="One row per customer; a change overwrites (type 1)",
            comments={"tenure_days": "Days from registration to the reference day"}),
        _declare("dim_restaurant", "restaurant_id", """
            restaurant_id varchar(8) required
            name varchar(150) required
            city varchar(50) required
            cuisine_type varchar(50)
            rating decimal(3,1)
            rating_band varchar(15)
            total_reviews int
            avg_prep_time_min smallint
            is_veg_only boolean required
            onboarded_date date""",
            comment="One row per merchant"),
        _declare("dim_menu_item", "item_id", """
            item_id varchar(9) required
            restaurant_id varchar(8) required
            item_name varchar(200) required
            category varchar(50)
            price decimal(8,2) required
            price_band varchar(15)
            is_available boolean required
            is_veg boolean required
            calories smallint""",
            foreign={"restaurant_id": "dim_restaurant"},
            comment="One row per offered item"),
        _declare("dim_delivery_agent", "agent_id", """
            agent_id varchar(7) required
            name varchar(100) required
            city varchar(50) required
            vehicle varchar(20)
            rating decimal(3,1)
            performance_tier varchar(20)
            experience_days int
            joined_date date""",
            comment="One row per courier"),
        _declare("fact_orders", "order_id", """
            order_id varchar(11) required
            customer_id varchar(10) required
            restaurant_id varchar(8) required
            agent_id varchar(7) required
            date_id int required
            order_timestamp timestamp required
            order_hour smallint
            time_of_day varchar(15)
            platform varchar(15)
            status varchar(15)
            is_delivered smallint required
            is_cancelled smallint required
            delivery_time_min smallint
            distance_km decimal(5,2)
            discount_pct smallint
            gross_total decimal(10,2) required
            discount_amount decimal(10,2) required
            delivery_fee decimal(7,2) required
            net_total decimal(10,2) required
            method varchar(25)""",
            foreign={
                "customer_id": "dim_customer",
                "restaurant_id": "dim_restaurant",
                "agent_id": "dim_delivery_agent",
                "date_id": "dim_date",
            },
            comment="Order grain",
            comments={"net_total": "gross_total - discount_amount + delivery_fee; 0 when cancelled"}),
        _declare("fact_order_items", "order_item_id", """
            order_item_id varchar(11) required
            order_id varchar(11) required
            item_id varchar(9) required
            customer_id varchar(10) required
            date_id int required
            quantity smallint required
            unit_price decimal(8,2) required
            revenue decimal(10,2) required""",
            foreign={
                "order_id": "fact_orders",
                "item_id": "dim_menu_item",
                "customer_id": "dim_customer",
                "date_id": "dim_date",
            },
            comment="Line-item grain"),
    )
}

# ---- marts and forecast ----------------------------------------------------

MONTHLY_MART = _declare("agg_monthly_revenue", ("year", "month", "city", "cuisine_type"), """
    year smallint
    month smallint
    month_name varchar(10)
    city varchar(50)
    cuisine_type varchar(50)
    total_orders bigint
    delivered_orders bigint
    cancelled_orders bigint
    gross_revenue decimal(20,2)
    net_revenue decimal(20,2)
    avg_order_value decimal(20,2)
    avg_delivery_min decimal(20,2)""",
    comment="Monthly totals by city and cuisine, refreshed after each load")

FORECAST = _declare("ml_order_forecast", "forecast_date", """
    forecast_date date
    predicted_orders bigint
    lower_bound bigint
    upper_bound bigint
    created_at timestamp""")

GROUP_FORECAST = _declare("ml_order_forecast_by_group", ("city", "cuisine_type", "forecast_date"), """
    city string
    cuisine_type string
    forecast_date date
    predicted_orders bigint
    lower_bound bigint
    upper_bound bigint
    created_at timestamp""")

FINDINGS = _declare("load_findings", ("finding", "table_name", "subject"), """
    finding string
    table_name string
    subject string
    amount double""")

METRICS = _declare("ml_model_metrics", "evaluated_at", """
    evaluated_at timestamp
    mape double
    mae double
    rmse double
    n_observations bigint""")

#: Rows of text sources that do not fit their declared types: their place in the input, why, and their text.
QUARANTINE = Table(
    "quarantined_rows",
    T.StructType().add("source", "string").add("file", "string").add("start", "long").add("row", "long")
    .add("reasons", T.ArrayType(T.StringType())).add("record", "string"),
    ("source", "file", "start", "row"),
)
