import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from ordermart.driver_views import raw_sources
from ordermart.plans import quality
from ordermart.schemas import MINIMUM_ROWS, STAR, Table, _declare


@pytest.fixture
def tables():
    parent = _declare("parent", "id", """
        id varchar(3) required
        name varchar(5)""")
    child = _declare("child", "id", """
        id bigint required
        parent_id varchar(3) required
        price decimal(4,2)""", unique=("parent_id",), foreign={"parent_id": "parent"})
    return {"parent": parent, "child": child}


@pytest.fixture
def frames(spark):
    return {
        "parent": spark.createDataFrame([("a", "ok"), ("b", "too long"), ("b", None), (None, "x")], "id string, name string"),
        "child": spark.createDataFrame(
            [(1, "a", Decimal("1.00")), (2, "z", Decimal("999.00")), (3, "z", None), (4, None, Decimal("99.99"))],
            "id long, parent_id string, price decimal(10,2)"),
    }


def test_constraint_audits(frames, tables):
    assert rows(quality.not_null_audit(frames, tables)) == [("child", "id", 0), ("child", "parent_id", 1), ("parent", "id", 1)]
    assert rows(quality.key_audit(frames, tables)) == [
        ("child", "id", 0, 0), ("child", "parent_id", 1, 1), ("parent", "id", 1, 1)
    ]
    assert rows(quality.foreign_key_audit(frames, tables)) == [("child", "parent_id", "parent", 1, 3, 1)]
    assert rows(quality.domain_audit(frames, tables)) == [
        ("child", "parent_id", "length <= 3", 0), ("child", "price", "decimal(4,2)", 1),
        ("parent", "id", "length <= 3", 0), ("parent", "name", "length <= 5", 1),
    ]
    assert rows(quality.row_counts(frames)) == [("child", 4), ("parent", 4)]
    assert rows(quality.orphans(frames["child"], "parent_id", frames["parent"], "id")) == [("z", 2), (None, 1)]


def test_profiles(spark):
    frame = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "b", None), (1, None, "x")], "a int, b string, c string")
    assert rows(quality.null_profile("t", frame)) == [("t", "b", Decimal("75")), ("t", "c", Decimal("25"))]
    assert rows(quality.duplicate_profile("t", frame)) == [("t", 4, 2)]
    assert rows(quality.null_profile("t", frame.filter("false"))) == []
    assert rows(quality.duplicate_profile("t", frame.filter("false"))) == [("t", 0, 0)]


def test_duplicate_profile_reads_and_shuffles_rows_once(spark, tmp_path):
    copies = [(i % 40 or None, "x" * (i % 3), float(i % 4)) for i in range(300)]
    spark.createDataFrame(copies, "a int, b string, c double").write.parquet(f"{tmp_path}/t")
    found = quality.duplicate_profile("t", spark.read.parquet(f"{tmp_path}/t"))
    assert rows(found) == [("t", 300, 300 - len(set(copies)))]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan


def test_lines_are_shuffled_once_for_the_payments(spark, tmp_path):
    lines = [(k, 10 + k % 3, k % 2, n, 1.0 + k % 5, 10.5) for k in range(1, 30) for n in (1, 1, 2)]
    lines += [(k, 12, 1, 1, 2.0, 7.25) for k in range(1, 30)] + [(None, 10, 0, 1, 1.0, 3.0)] * 2
    tables = {
        "nation": ([(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(0, "R")], "r_regionkey long, r_name string"),
        "customer": ([(1, "C#1", 0, 1.0)], "c_custkey long, c_name string, c_nationkey long, c_acctbal double"),
        "supplier": ([(0, "S#0", 0), (1, "S#1", 0)], "s_suppkey long, s_name string, s_nationkey long"),
        "part": ([(k, "a b", "t", 910.0) for k in (10, 11, 12)], "p_partkey long, p_name string, p_type string, p_retailprice double"),
        "orders": (
            [(k, 1, "F", "1-URGENT", dt.datetime(1996, 1, 1 + k % 28)) for k in range(1, 30)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp",
        ),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    payments = raw_sources(spark, str(tmp_path))["payments"]
    found = {r["order_id"]: r["gross_total"] for r in payments.collect()}
    assert found == {str(k): sum(Decimal(str(x[-1])) for x in {x for x in lines if x[0] == k}) for k in range(1, 30)}
    assert "hashpartitioning(order_item_id" not in payments._jdf.queryExecution().executedPlan().toString()


def test_flag_mismatches(spark):
    frame = spark.createDataFrame([("O1", 1, "Delivered"), ("O2", 1, "Refunded"), ("O3", 0, "Refunded")],
                                  "order_id string, is_delivered int, status string")
    assert rows(quality.flag_mismatches(frame)) == [("O2", "Refunded")]


def test_gate_names_every_failure(spark):
    sources = {name: spark.range(least) for name, least in MINIMUM_ROWS.items()}
    quality.require_gate(quality.source_gate(spark, sources))
    sources["orders"] = spark.range(499)
    sources["payments"] = None
    gate = quality.source_gate(spark, sources)
    assert rows(gate.filter("outcome <> 'OK'")) == [("orders", 499, 500, "LOW ROWS"), ("payments", None, 500, "MISSING")]
    with pytest.raises(quality.GateFailed) as failure:
        quality.require_gate(gate)
    assert "orders" in str(failure.value) and "payments" in str(failure.value)


def test_declarations():
    assert [len(STAR[n].columns) for n in STAR] == [13, 11, 10, 9, 8, 20, 8]
    assert sum(len(t.foreign) for t in STAR.values()) == 9
    assert STAR["fact_orders"].schema["net_total"].metadata["comment"]
    assert all(isinstance(t, Table) and set(t.key) <= set(t.columns) for t in STAR.values())
