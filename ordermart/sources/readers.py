"""Raw sources as DataFrames with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.schemas import SOURCES, Table

CORRUPT = "_corrupt_record"
INGEST = "_ingest"


class MissingSource(FileNotFoundError):
    """At least one source path does not exist."""


def with_ingest_order(frame: DataFrame) -> DataFrame:
    """Add the place of every row in the input: file, start of its split, position.

    Numbers grow along each split, whatever splits a task reads, so ordering by
    this column is the order in the files.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return frame.select("*", place.alias(INGEST))


def read_source(
    spark: SparkSession, root: str, table: Table, fmt: str = "csv", strict: bool = False, multi_line: bool = False,
    ingest: bool = False,
) -> DataFrame | None:
    """One source, or None when its path is absent.

    CSV rows that do not fit the schema are kept, with their text in
    ``_corrupt_record`` (see ``split_corrupt``); with ``strict`` they fail the
    job instead. ``multi_line`` admits line breaks inside quotes, at the price
    that a file is no longer split between tasks. ``ingest`` adds the place of
    each row in the input.
    """
    placed = with_ingest_order if ingest else lambda frame: frame
    path = f"{root.rstrip('/')}/{table.name}.{fmt}"
    try:
        if fmt == "parquet":
            names = [*table.columns, INGEST] if ingest else table.columns
            return placed(spark.read.parquet(path)).select(*names)
        # All columns are parsed even for a query on few, so the same rows count as corrupt everywhere.
        reader = spark.read.options(header=True, escape='"', multiLine=multi_line, columnPruning=False)
        if strict:
            return placed(reader.schema(table.schema).csv(path, mode="FAILFAST"))
        schema = T.StructType([*table.schema.fields, T.StructField(CORRUPT, T.StringType())])
        return placed(reader.schema(schema).csv(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_present(
    spark: SparkSession, root: str, fmt: str = "csv", tables: Mapping[str, Table] = SOURCES, **options: bool
) -> dict[str, DataFrame | None]:
    """Every declared source; absent ones map to None, for the gate to report."""
    return {name: read_source(spark, root, table, fmt, **options) for name, table in tables.items()}


def read_sources(
    spark: SparkSession, root: str, fmt: str = "csv", tables: Mapping[str, Table] = SOURCES, **options: bool
) -> dict[str, DataFrame]:
    """Every declared source; raises before any job runs when a path is absent."""
    frames = read_present(spark, root, fmt, tables, **options)
    absent = [name for name, frame in frames.items() if frame is None]
    if absent:
        raise MissingSource(f"missing under {root}: {', '.join(absent)}")
    return {name: frame for name, frame in frames.items() if frame is not None}


def split_corrupt(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, rows that do not) of a CSV source."""
    if CORRUPT not in frame.columns:
        return frame, frame.limit(0)
    return frame.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), frame.filter(F.col(CORRUPT).isNotNull())


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL text over the given frames, by name; temporary views of the session are as before afterwards."""

    def temporary(name: str) -> bool:
        return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary

    hidden = {name: spark.table(name) for name in views if temporary(name)}
    try:
        for name, frame in views.items():
            frame.createOrReplaceTempView(name)
        return spark.sql(text)  # names are resolved here, so the views are not needed any longer
    finally:
        for name in views:
            if name in hidden:
                hidden[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
