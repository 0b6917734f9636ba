from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ordermart.plans.star import menu_item_dim
from ordermart.schemas import METRICS, MONTHLY_MART, SOURCES, Table
from ordermart.session import build_session, shared_dir
from ordermart.sources import MissingSource, create_if_absent, publish, read_sources, replace_table, run_sql, split_corrupt
from ordermart.sources.readers import INGEST
from ordermart.sources.writers import complete_versions, conform, current_version, publish_version

PART = Table("part", T.StructType([
    T.StructField("forecast_date", T.DateType(), True, {"comment": "the day"}), T.StructField("predicted_orders", T.LongType()),
]), ("forecast_date",))

SHOPS = '''restaurant_id,name,city,cuisine_type,rating,total_reviews,avg_prep_time_min,is_veg_only,onboarded_date
R1,"Rao, Sons and ""Co""",Pune,Thai,4.2,10,20,True,2022-05-10
R2,Plain,Goa,,3.0,20,30,False,2023-01-01
R3,Broken,Goa,Thai,not a number,20,30,False,2023-01-01
'''


def one_source(name):
    return {name: SOURCES[name]}


def test_csv_with_quotes_and_broken_rows(spark, tmp_path):
    (tmp_path / "restaurants.csv").write_text(SHOPS)
    frame = read_sources(spark, str(tmp_path), tables=one_source("restaurants"))["restaurants"]
    good, bad = split_corrupt(frame)
    assert good.schema == SOURCES["restaurants"].schema or good.columns == SOURCES["restaurants"].columns
    assert [r.name for r in good.orderBy("restaurant_id").collect()] == ['Rao, Sons and "Co"', "Plain"]
    assert good.filter("restaurant_id = 'R2'").first().cuisine_type is None
    assert [r.restaurant_id for r in bad.collect()] == ["R3"]
    assert frame.count() == 3


def test_missing_sources_are_all_named(spark, tmp_path):
    (tmp_path / "restaurants.csv").write_text(SHOPS)
    with pytest.raises(MissingSource) as failure:
        read_sources(spark, str(tmp_path))
    assert "orders" in str(failure.value) and "payments" in str(failure.value) and "restaurants" not in str(failure.value)


def test_parquet_source(spark, tmp_path):
    frame = spark.createDataFrame([("I1", "R1", "x", "y", 1.0, True, True, 5)], SOURCES["menu_items"].columns)
    frame.withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "menu_items.parquet"))
    read = read_sources(spark, str(tmp_path), "parquet", one_source("menu_items"))["menu_items"]
    assert read.columns == SOURCES["menu_items"].columns and read.count() == 1


def test_publish_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    publish(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    publish(spark.range(2), path, mode="append")
    assert spark.read.parquet(path).count() == 4


def test_partitioned_write_splits_by_size_not_by_key(spark, tmp_path):
    """A month with most rows is not written by one task; a small one stays one file."""
    frame = spark.range(0, 400000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 70).otherwise(99).alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        publish(frame, str(tmp_path / "t"), partition_by=["month"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "t/month=99").glob("*.parquet"))) > 3
    assert len(list((tmp_path / "t/month=0").glob("*.parquet"))) <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400000


def test_catalog_table(spark):
    create_if_absent(spark, MONTHLY_MART, partition_by=["year", "month"])
    create_if_absent(spark, MONTHLY_MART, partition_by=["year", "month"])
    row = (2024, 1, "January", "Pune", "Thai", 5, 4, 1, 10.5, 9.5, 2.0, 30.0)
    frame = spark.createDataFrame([row], MONTHLY_MART.columns)
    for _ in range(2):
        replace_table(frame, MONTHLY_MART, columns_last=["year", "month"])
        assert spark.table(MONTHLY_MART.name).count() == 1
    found = spark.table(MONTHLY_MART.name).select(*MONTHLY_MART.columns)
    assert found.first().city == "Pune" and found.schema["net_revenue"].dataType == MONTHLY_MART.schema["net_revenue"].dataType
    create_if_absent(spark, METRICS)
    assert spark.table(METRICS.name).count() == 0
    spark.sql(f"DROP TABLE {MONTHLY_MART.name}")
    spark.sql(f"DROP TABLE {METRICS.name}")


def test_sql_text(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    found = run_sql(spark, "SELECT k, sum(v) FILTER (WHERE v > 1) AS s FROM t GROUP BY k", {"t": frame})
    assert rows(found) == [("a", 2), ("b", 3)]


def test_only_a_local_master_falls_back_to_its_own_folder():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: default),
            sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
        )

    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert build_session() is spark or build_session().sparkContext is spark.sparkContext


def test_a_cluster_refuses_folders_of_one_machine():
    def session(folder, default="hdfs://head"):
        named = {"spark.checkpoint.dir": folder, "spark.hadoop.fs.defaultFS": default}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, otherwise=None: named.get(key, otherwise)),
            sparkContext=SimpleNamespace(master="yarn", applicationId="app"),
        )

    assert shared_dir(session("hdfs://head/shared/")) == "hdfs://head/shared"
    assert shared_dir(session("/shared")) == "/shared"
    for folder, default in (("file:///tmp/x", "hdfs://head"), ("file:/tmp/x", "hdfs://head"), ("/tmp/x", "file:///")):
        with pytest.raises(ValueError, match="one machine"):
            shared_dir(session(folder, default))


def test_a_cluster_may_share_a_mounted_folder(spark, tmp_path):
    """A standalone master whose shared folder is a path: accepted if the driver sees what the tasks write."""
    def session(folder, written, name="app"):
        context = SimpleNamespace(master="spark://head:7077", applicationId=name, defaultParallelism=3)
        named = {"spark.checkpoint.dir": folder}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, otherwise=None: named.get(key, otherwise)),
            sparkContext=context, read=spark.read, range=written,
        )

    for folder in (f"file://{tmp_path}/x", f"{tmp_path}/y/"):
        assert shared_dir(session(folder, spark.range)) == folder.rstrip("/")
        assert shared_dir(session(folder, None)) == folder.rstrip("/")  # asked once
        with pytest.raises(ValueError, match="one machine"):
            shared_dir(session(folder, lambda *_: spark.range(1), "other"))


def test_first_in_the_file_is_kept(spark, tmp_path):
    """Copies that differ, in a file long enough for several splits."""
    lines = ["item_id,restaurant_id,item_name,category,price,is_available,is_veg,calories"]
    lines += [f"I{i % 4000},R1,copy {i // 4000},x,1.00,True,True,5" for i in range(12000)]
    (tmp_path / "menu_items.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        frame = read_sources(spark, str(tmp_path), tables=one_source("menu_items"), strict=True, ingest=True)["menu_items"]
        assert frame.rdd.getNumPartitions() > 3
        kept = menu_item_dim(frame, order=[INGEST])
        assert kept.count() == 4000 and rows(kept.select("item_name").distinct()) == [("copy 0",)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    for version in ("1", "2", "2", "3"):
        publish_version(spark.range(int(version)), root, version, keep=2)
    spark.range(9).write.parquet(f"{root}/4")
    (tmp_path / "t/4/_SUCCESS").unlink()
    assert complete_versions(spark, root) == ["2", "3"] and current_version(spark, root).count() == 3


def test_sql_text_leaves_views_alone(spark):
    spark.range(7).createOrReplaceTempView("mine")
    assert run_sql(spark, "SELECT count(*) FROM mine", {"mine": spark.range(2)}).first()[0] == 2
    assert spark.table("mine").count() == 7
    assert run_sql(spark, "SELECT count(*) FROM other", {"other": spark.range(2)}).first()[0] == 2
    assert not spark.catalog.tableExists("other")
    spark.catalog.dropTempView("mine")


def test_declared_types_and_comments(spark):
    frame = conform(spark.createDataFrame([("2024-01-01", 3, 7)], "forecast_date string, predicted_orders int, extra int"), PART)
    assert frame.columns == ["forecast_date", "predicted_orders", "extra"]
    assert [f.dataType.simpleString() for f in frame.schema.fields] == ["date", "bigint", "int"]
    assert frame.schema["forecast_date"].metadata == {"comment": "the day"}
