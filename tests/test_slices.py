"""Facts built in slices of their keys, and what lies on disk meanwhile."""

import datetime as dt
import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordermart import driver_views as dv
from ordermart.operators import slices
from ordermart.plans import job
from ordermart.session import child_names, shared_dir

DAYS = [dt.datetime(1996, 1 + k % 3, 1 + k % 28) for k in range(60)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders that come twice, lines that come twice, and both without a key."""
    root = str(tmp_path_factory.mktemp("tables"))
    orders = [(k, k % 7, "FOP"[k % 3], 10.0 * k, DAYS[k], f"{1 + k % 5}-X") for k in range(60)]
    orders += [*orders[:5], (3, 6, "F", 1.0, DAYS[0], "1-X"), (None, 1, "F", 5.0, DAYS[2], "2-X"), (None, 2, "O", 6.0, DAYS[3], None)]
    lines = [
        (k % 50, k % 11, k % 4, k % 3, float(1 + k % 5), 100.25 + k % 13, 0.0, 0.0, "N", "O", DAYS[k % 60]) for k in range(240)
    ]
    lines += [*lines[:20], (None, 1, 1, 1, 1.0, 9.5, 0.0, 0.0, "N", "O", DAYS[1]), (None, None, 2, 2, 2.0, 8.5, 0.0, 0.0, "A", "F", DAYS[1]),
              (7, None, None, None, 3.0, 7.75, None, None, None, None, None)]
    data = {
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "customer": ([(k, f"C#{k}", 0, 999.0 * k) for k in range(7)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
        "supplier": ([(k, f"S#{k}", 0) for k in range(4)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(k, "a b", "t", 910.0 + k) for k in range(11)], "p_partkey long, p_name string, p_type string, p_retailprice double"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (found, schema) in data.items():
        spark.createDataFrame(found, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def load(spark, tables, path):
    return job.load_star(dv.raw_sources(spark, tables), dv.calendar(spark, tables), str(path), as_of=dv.AS_OF, price_bands=dv.PRICE_BANDS)


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f"{at}/{f}" for folder in folders for at, _, found in os.walk(folder.getPath()) for f in found if f.startswith("shuffle_")}


def left_since(spark, before):
    """Shuffle files written since, once those of queries that have ended had time to go."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_the_star_is_the_same_in_any_number_of_slices(spark, tables, tmp_path, monkeypatch):
    whole = load(spark, tables, tmp_path / "whole")
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    assert slices.slice_count(spark.read.parquet(f"{tables}/orders.parquet")) == slices.MOST
    lines = dv.copy_numbered(spark, tables, str(tmp_path / "lines"))
    raw = dv.raw_sources(spark, tables, lines)
    cut = job.load_star(raw, dv.calendar(spark, tables), str(tmp_path / "cut"), as_of=dv.AS_OF, price_bands=dv.PRICE_BANDS)
    for name, frame in dv.raw_sources(spark, tables).items():
        assert rows(raw[name]) == rows(frame), name
    for name, frame in whole.items():
        assert frame.columns == cut[name].columns and rows(frame) == rows(cut[name]), name
    assert whole["fact_orders"].count() == 61 and whole["fact_orders"].filter("order_id is null").count() == 1
    assert whole["fact_order_items"].filter("order_item_id is null").count() == 1
    assert sum(len(rows(dv.numbered_lines(spark.read.parquet(f"{tables}/lineitem.parquet")).filter(s))) for s in slices.slices("l_orderkey", 5)) == 263


def test_no_write_of_the_star_leaves_its_shuffles(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    before, seen, publish = shuffle_files(spark), [], job.publish

    def watched(frame, target, *more, **named):
        if target.endswith("fact_order_items"):  # all other writes have ended
            seen.append(left_since(spark, before))
        publish(frame, target, *more, **named)

    monkeypatch.setattr(job, "publish", watched)
    load(spark, tables, tmp_path)
    assert seen == [set()] * slices.MOST
    assert not left_since(spark, before)


def test_the_copy_of_the_lines_goes_with_the_load(spark, tables):
    before = set(child_names(spark, shared_dir(spark)))
    found = dv.star(spark, tables)
    new = set(child_names(spark, shared_dir(spark))) - before
    assert [child_names(spark, f"{shared_dir(spark)}/{name}") for name in new] == [["star"]]
    assert found["fact_order_items"].agg(F.count(F.lit(1))).first()[0] == len(
        {r["order_item_id"] for r in dv.raw_sources(spark, tables)["order_items"].select("order_item_id").collect()}
    )
