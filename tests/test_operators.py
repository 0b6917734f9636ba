import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart.operators.dedup import keep_first
from ordermart.operators.ranking import first_with_ntile, ntile_scores, with_ntile, with_row_number
from ordermart.operators.upsert import upsert
from ordermart.operators.versioned import _touched, manifest, read_versioned, upsert_versioned, write_versioned


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_keep_first_uses_the_stated_order(spark):
    frame = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"), (None, 1, "x"), (None, 2, "y")],
                                  "k string, seq int, v string")
    assert rows(keep_first(frame, "k", ["seq"])) == rows(frame.filter("v in ('early', 'only', 'x')"))
    assert rows(keep_first(frame, "k", [F.desc("seq")])) == rows(frame.filter("v in ('late', 'only', 'y')"))


def test_keep_first_by_all_columns_is_repeatable(spark):
    frame = spark.createDataFrame([(i % 7, i % 3, i % 5) for i in range(200)], "k int, a int, b int")
    expected = sorted(min((i % 7, i % 3, i % 5) for i in range(200) if i % 7 == k) for k in range(7))
    for parts in (1, 5):
        assert rows(keep_first(frame.repartition(parts), "k")) == expected


def test_keep_first_cuts_copies_before_the_shuffle(spark):
    """A key with a third of all rows reaches the reducer as one row per map task."""
    frame = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    once = keep_first(frame, "k", ["id"])
    plan = plan_of(once)
    assert plan.index("WindowGroupLimit") and "Partial" in plan
    assert once.count() == 20001
    assert once.filter("k = 0").first()["id"] == 0


@pytest.mark.parametrize("size, tiles", [(1000, 5), (1003, 4), (17, 5), (3, 5), (1, 4), (5, 5), (0, 4)])
def test_ntile_equals_builtin(spark, size, tiles):
    random.seed(size)
    data = [(i, random.choice([None, 0, 0, 0, random.randint(-50, 50)])) for i in range(size)]
    frame = spark.createDataFrame(data, "id long, v int").repartition(4)
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    builtin = frame.withColumn("tile", F.ntile(tiles).over(Window.orderBy(*order)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # force several sort partitions
    try:
        assert rows(with_ntile(frame, tiles, order, "tile")) == rows(builtin)
        best = builtin.orderBy(*order).limit(50)
        assert rows(first_with_ntile(frame, tiles, order, "tile", limit=50)) == rows(best)
        numbered = with_row_number(frame, order, "n")
        assert rows(numbered) == rows(frame.withColumn("n", F.row_number().over(Window.orderBy(*order))))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_scores_equal_separate_ntiles_where_one_value_is_common(spark):
    random.seed(7)
    # one value of a holds two thirds of the rows
    data = [(f"c{i:05d}", random.choice([1, 1, random.randint(2, 9)]), random.randint(0, 10**12)) for i in range(2003)]
    frame = spark.createDataFrame(data, "id string, a int, b long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ntile_scores(frame, "id", {"x": -F.col("a"), "y": F.col("b")}, tiles=5)
        expected = frame.select(
            "id",
            F.ntile(5).over(Window.orderBy(F.desc("a"), "id")).alias("x"), (-F.col("a")).cast("long").alias("x_value"),
            F.ntile(5).over(Window.orderBy("b", "id")).alias("y"), F.col("b").alias("y_value"),
        )
        assert rows(found) == rows(expected)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_equal_values_are_cut_into_several_sort_partitions(spark):
    frame = spark.range(0, 40000, 1, 8).select(F.lit(1).alias("v"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = frame.orderBy("v", "id").groupBy(F.spark_partition_id()).count().collect()
        assert len(placed) == 8 and max(r["count"] for r in placed) < 8000
        assert with_row_number(frame, [F.col("v"), F.col("id")], "n").filter("n <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


OLD = [(2024, 1, "A", 10, 1.0), (2024, 1, None, 20, 2.0), (2024, 2, "A", 30, 3.0)]
NEW = [(2024, 1, "A", 99, 9.0), (2024, 1, None, 98, 8.0), (2024, 1, "B", 97, 7.0)]
SHAPE = "year int, month int, city string, orders int, net double"
MERGED = [(2024, 1, "A", 10, 9.0), (2024, 1, "B", 97, 7.0), (2024, 1, None, 20, 8.0), (2024, 2, "A", 30, 3.0)]


def test_upsert_changes_only_named_columns(spark):
    old, new = spark.createDataFrame(OLD, SHAPE), spark.createDataFrame(NEW, SHAPE)
    once = upsert(old, new, ["year", "month", "city"], ["net"])
    assert rows(once) == sorted(MERGED, key=repr)
    assert rows(upsert(once, new, ["year", "month", "city"], ["net"])) == sorted(MERGED, key=repr)


KEYS, PARTS = ["year", "month", "city"], ["year", "month"]


def versioned(spark, root, version=None):
    return rows(read_versioned(spark, root, spark.createDataFrame([], SHAPE).schema, version))


def test_versioned_upsert_writes_touched_partitions_only(spark, tmp_path):
    root = str(tmp_path / "mart")
    write_versioned(spark.createDataFrame(OLD, SHAPE), root, "1", PARTS)
    for version in ("2", "3"):
        upsert_versioned(spark.createDataFrame(NEW, SHAPE), root, version, KEYS, ["net"], PARTS)
        assert versioned(spark, root) == sorted(MERGED, key=repr)
        assert [p.name for p in (tmp_path / f"mart/data/_version={version}/year=2024").iterdir() if "=" in p.name] == ["month=1"]
    assert manifest(spark, root) == {"year=2024/month=1": "3", "year=2024/month=2": "1"}
    assert versioned(spark, root, "1") == sorted(OLD, key=repr)  # earlier versions can still be read
    upsert_versioned(spark.createDataFrame(NEW, SHAPE), root, "4", KEYS, ["net"], PARTS, keep=1)
    assert {p.name for p in (tmp_path / "mart/data").iterdir() if "=" in p.name} == {"_version=1", "_version=4"}
    assert not (tmp_path / "mart/data/_version=1/year=2024/month=1").exists()
    assert versioned(spark, root) == sorted(MERGED, key=repr)


def test_readers_see_the_old_table_during_and_after_a_failed_upsert(spark, tmp_path):
    root = str(tmp_path / "mart")
    write_versioned(spark.createDataFrame(OLD, SHAPE), root, "1", PARTS)
    reading = read_versioned(spark, root, spark.createDataFrame([], SHAPE).schema)
    broken = spark.createDataFrame([(2024, 1, "A", 1, "1.0"), (2024, 2, "A", 1, "none")], SHAPE.replace("double", "string"))
    broken = broken.withColumn("net", F.col("net").cast("double"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write_versioned(broken, root, "2", PARTS, keep_others=True)
    assert rows(reading) == sorted(OLD, key=repr) == versioned(spark, root)
    upsert_versioned(spark.createDataFrame(NEW, SHAPE), root, "3", KEYS, ["net"], PARTS)
    assert rows(reading) == sorted(OLD, key=repr)  # a reader that has started stays with its version
    assert versioned(spark, root) == sorted(MERGED, key=repr)
    assert not (tmp_path / "mart/data/_version=2").exists()


def test_versioned_upsert_creates_an_absent_table_and_takes_nothing(spark, tmp_path):
    root = str(tmp_path / "absent")
    assert versioned(spark, root) == []
    upsert_versioned(spark.createDataFrame(NEW, SHAPE), root, "1", KEYS, ["net"], PARTS)
    assert versioned(spark, root) == sorted(NEW, key=repr)
    upsert_versioned(spark.createDataFrame([], SHAPE), root, "2", KEYS, ["net"], PARTS)
    assert versioned(spark, root) == sorted(NEW, key=repr)


def test_versioned_upsert_reads_touched_partitions_only(spark, tmp_path):
    root = str(tmp_path / "mart")
    write_versioned(spark.createDataFrame(OLD, SHAPE), root, "1", PARTS)
    shape = spark.createDataFrame([], SHAPE).schema
    affected = read_versioned(spark, root, shape).filter(_touched(spark.createDataFrame(NEW, SHAPE), PARTS))
    scanned = affected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scanned and "2024" in scanned[scanned.index("PartitionFilters: ["):scanned.index("PushedFilters")]


def test_keep_first_puts_nulls_last(spark):
    frame = spark.createDataFrame([(1, None, 7), (1, "x", 5), (2, None, 1)], "k int, v string, n int")
    assert rows(keep_first(frame, "k")) == [(1, "x", 5), (2, None, 1)]
    assert rows(keep_first(frame, "k", ["v"])) == [(1, "x", 5), (2, None, 1)]


def plain_scores(frame, scores, tiles):
    columns = []
    for name, value in scores.items():
        order = Window.orderBy(value.cast("long").asc_nulls_first(), "id")
        columns += [F.ntile(tiles).over(order).alias(name), value.cast("long").alias(f"{name}_value")]
    return frame.select("id", *columns)


@pytest.mark.parametrize("n,tiles", [(0, 5), (1, 5), (3, 5), (5, 5), (7, 2), (500, 5), (1003, 7), (40, 1)])
def test_tiles_equal_ntile_on_ties_nulls_and_few_rows(spark, n, tiles):
    frame = spark.range(0, n, 1, 4).select(
        "id", (F.col("id") * 7 % 11).alias("a"), F.when(F.col("id") % 3 != 0, F.col("id") % 40).alias("b"),
        F.lit(None).cast("long").alias("c"), F.lit(4).alias("d"),
        (F.xxhash64("id")).alias("e"), F.when(F.col("id") % 2 == 0, F.lit(-(2**62))).otherwise(F.col("id")).alias("f"),
    )
    scores = {"x": -F.col("a"), **{k: F.col(k) for k in "bcdef"}}
    assert rows(ntile_scores(frame, "id", scores, tiles)) == rows(plain_scores(frame, scores, tiles))


def test_tiles_are_found_without_sorting_all_rows(spark):
    frame = spark.range(0, 20_000, 1, 4).select(F.concat(F.lit("k"), F.col("id")).alias("id"), F.xxhash64("id").alias("a"))
    found = ntile_scores(frame, "id", {"x": F.col("a")}, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    assert rows(found) == rows(plain_scores(frame, {"x": F.col("a")}, 5))


def test_versioned_upsert_keeps_rows_of_a_null_partition(spark, tmp_path):
    shape, root = "year int, city string, net double", str(tmp_path / "t")
    first = [(None, "a", 1.0), (None, "b", 2.0), (2024, "c", 3.0)]
    upsert_versioned(spark.createDataFrame(first, shape), root, "1", ["year", "city"], ["net"], ["year"])
    for version in "23":
        more = spark.createDataFrame([(None, "z", 9.0), (None, "a", 5.0)], shape)
        upsert_versioned(more, root, version, ["year", "city"], ["net"], ["year"])
    found = read_versioned(spark, root, spark.createDataFrame([], shape).schema)
    assert rows(found) == rows(spark.createDataFrame([(None, "a", 5.0), (None, "b", 2.0), (None, "z", 9.0), (2024, "c", 3.0)], shape))
