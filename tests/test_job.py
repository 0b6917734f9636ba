"""The daily job over the raw sources written out as CSV."""

import dataclasses
import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordermart import driver_views as dv
from ordermart.__main__ import main, settings_from
from ordermart.plans import quality
from ordermart.plans.job import AuditFailed, Settings, audit_star, current_star, run_daily, run_load, run_mart
from ordermart.plans.marts import upserted_mart
from ordermart.schemas import SOURCES, STAR
from ordermart.sources.staging import stage
from ordermart.sources.writers import current_version

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def csv_root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for name, frame in dv.raw_sources(spark, SF).items():
        texts = [F.col(c).cast("string").alias(c) for c in SOURCES[name].columns]
        frame.select(*texts).write.csv(
            str(root / f"{name}.csv"), header=True, escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    return str(root)


def settings(csv_root, warehouse, **more):
    return Settings(
        source_root=csv_root, warehouse=str(warehouse), calendar_start="1995-01-01", calendar_end="2001-08-01",
        as_of="2001-08-01", run_at=dt.datetime(2001, 8, 1, 2, 30),
        **{"minimums": {name: 1 for name in SOURCES}, "multi_line": True, **more},
    )


@pytest.fixture(scope="module")
def first_run(spark, csv_root, tmp_path_factory):
    conf = settings(csv_root, tmp_path_factory.mktemp("warehouse"))
    return conf, run_daily(spark, conf)


def test_daily_run(spark, csv_root, first_run):
    conf, star = first_run
    home = conf.warehouse
    assert {n: f.columns for n, f in star.items()} == {n: t.columns for n, t in STAR.items()}
    counts = dict(rows(quality.row_counts(star)))
    raw = dv.raw_sources(spark, SF)
    assert counts["fact_orders"] == raw["orders"].count()
    assert counts["fact_order_items"] == raw["order_items"].select("order_item_id").distinct().count()

    mart = current_version(spark, f"{home}/agg_monthly_revenue")
    known = star["fact_orders"].join(star["dim_date"], "date_id").join(star["dim_restaurant"], "restaurant_id")
    assert mart.agg(F.sum("net_revenue")).first()[0] == known.agg(F.sum("net_total")).first()[0]
    assert mart.agg(F.sum("total_orders")).first()[0] == known.count()

    future = current_version(spark, f"{home}/ml_order_forecast")
    assert future.count() == 30 and future.agg(F.min("forecast_date")).first()[0] > dt.date(2001, 7, 1)

    mart_rows = mart.count()

    # a second run replaces the forecast, appends metrics, and becomes current
    run_daily(spark, dataclasses.replace(conf, run_at=dt.datetime(2001, 8, 2, 2, 30)))
    assert spark.read.parquet(f"{home}/ml_model_metrics").count() == 2
    assert current_version(spark, f"{home}/ml_order_forecast").count() == 30
    assert current_version(spark, f"{home}/agg_monthly_revenue").count() == mart_rows
    current = current_star(spark, home)
    assert dict(rows(quality.row_counts(current))) == counts
    assert "20010802" in current["fact_orders"].inputFiles()[0]


def test_star_from_csv_equals_star_from_tables(spark, first_run):
    from_csv, from_tables = first_run[1], dv.star(spark, SF)
    # Of several copies of a line the first is kept, and text ids sort unlike numbers.
    compared = {name: STAR[name].columns for name in ("dim_restaurant", "dim_customer", "dim_delivery_agent", "fact_orders")}
    compared["fact_order_items"] = ["order_item_id", "order_id", "customer_id", "date_id"]
    for name, columns in compared.items():
        texts = [F.col(c).cast("string") for c in columns]
        assert rows(from_csv[name].select(*texts)) == rows(from_tables[name].select(*texts)), name


def test_gate_stops_the_run(spark, csv_root, tmp_path):
    with pytest.raises(quality.GateFailed):
        run_daily(spark, settings(csv_root, tmp_path, minimums={**{n: 1 for n in SOURCES}, "orders": 10**9}))
    assert not list(tmp_path.iterdir())


def test_repeated_key_is_refused(spark):
    star = dict(dv.star(spark, SF))
    star["dim_restaurant"] = star["dim_restaurant"].unionByName(star["dim_restaurant"])
    with pytest.raises(AuditFailed, match="dim_restaurant"):
        audit_star(star)


def test_malformed_rows_fail_the_run(spark, csv_root, tmp_path):
    """Without multi-line reading the line breaks inside names make broken rows."""
    with pytest.raises(Exception, match="MALFORMED"):
        run_daily(spark, settings(csv_root, tmp_path, multi_line=False))
    assert not (tmp_path / "runs").exists()


def test_text_sources_are_parsed_once(spark, csv_root, tmp_path, monkeypatch):
    """Once the copies are written the text is gone, and the load still comes to its end."""
    import shutil

    from ordermart.plans import job

    raw = tmp_path / "raw"
    shutil.copytree(csv_root, raw)

    def stage_and_lose(spark, sources, path):
        staged = stage(spark, sources, path)
        raw.rename(tmp_path / "moved")
        return staged

    monkeypatch.setattr(job, "stage", stage_and_lose)
    star = run_load(spark, settings(str(raw), tmp_path / "warehouse"))
    assert star["fact_orders"].count() == dv.raw_sources(spark, SF)["orders"].count()


def test_quarantine(spark, csv_root, tmp_path):
    """Three bad rows do not stop a load; they are named with their place and the reasons."""
    import shutil

    raw = tmp_path / "raw"
    shutil.copytree(csv_root, raw)
    with (raw / "orders.csv" / "part-bad.csv").open("w") as f:
        f.write(",".join(SOURCES["orders"].columns) + "\n")
        f.write("901,1,1,1,2020-13-45 00:00:00,30,1.5,Delivered,0,Web\n902,1,1,1,2000-01-01 10:00:00,soon,far,Delivered,0,Web\n903,1\n")
    conf = settings(str(raw), tmp_path / "warehouse", mart="upsert")
    with pytest.raises(Exception, match="MALFORMED"):
        run_load(spark, conf)
    conf = dataclasses.replace(conf, quarantine=True)
    star = run_load(spark, conf)
    assert star["fact_orders"].count() == dv.raw_sources(spark, SF)["orders"].count()
    bad = current_version(spark, f"{conf.warehouse}/quarantined_rows").orderBy("row").collect()
    assert [(r.source, r.reasons) for r in bad] == [
        ("orders", ["order_timestamp: not a timestamp_ntz"]),
        ("orders", ["delivery_time_min: not a int", "distance_km: not a decimal(5,2)"]),
        ("orders", ["row: not 10 fields"]),
    ]
    assert all(r.file.endswith("part-bad.csv") for r in bad) and bad[2].record == "903,1"
    # the mart of such a star can be kept by upserts
    for day in (3, 4):
        run_mart(spark, dataclasses.replace(conf, run_at=dt.datetime(2001, 8, day)))
    mart = upserted_mart(spark, f"{conf.warehouse}/agg_monthly_revenue_upserted")
    known = star["fact_orders"].join(star["dim_date"], "date_id").join(star["dim_restaurant"], "restaurant_id")
    assert mart.agg(F.sum("net_revenue")).first()[0] == known.agg(F.sum("net_total")).first()[0]


def test_command_line(spark, first_run):
    step, conf = settings_from(["forecast", "raw", first_run[0].warehouse + "/", "--horizon", "7"])
    assert step == "forecast" and conf.horizon == 7 and conf.source_format == "csv"
    before = spark.read.parquet(f"{conf.home}/ml_model_metrics").count()
    main(["forecast", "raw", conf.warehouse, "--horizon", "7"])
    assert current_version(spark, f"{conf.home}/ml_order_forecast").count() == 7
    main(["forecast", "raw", conf.warehouse, "--horizon", "7"])
    assert spark.read.parquet(f"{conf.home}/ml_model_metrics").count() == before + 2
    with pytest.raises(SystemExit):
        settings_from(["sideways", "raw", "home"])
