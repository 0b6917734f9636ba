"""Table writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.schemas import Table
from ordermart.session import child_names, remove_path


def publish(
    frame: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_touched: bool = False,
    sort_by: Sequence[str] = (),
    compression: str | None = None,
) -> None:
    """Write Parquet: ``overwrite`` replaces, ``append`` adds.

    Partitioned writes are rebalanced on the partition columns, so that a small
    partition is one file and a large one is split over several tasks by size.
    Rows are sorted by ``sort_by`` inside each file, so that ranges of it are
    skipped by statistics.
    With ``only_touched`` an overwrite replaces just the partitions present in
    ``frame``. Without ``compression`` files are packed as the session says.
    """
    writer = frame
    if partition_by:
        writer = frame.hint("rebalance", *partition_by)
    if sort_by:
        writer = writer.sortWithinPartitions(*partition_by, *sort_by)
    out = writer.write.mode(mode)
    if partition_by:
        out = out.partitionBy(*partition_by)
    if only_touched:
        out = out.option("partitionOverwriteMode", "dynamic")
    out.parquet(path, compression=compression)


def conform(frame: DataFrame, table: Table) -> DataFrame:
    """The declared columns with their declared types and comments; others stay behind them."""
    declared = [
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata or {}) for f in table.schema.fields
    ]
    return frame.select(*declared, *[c for c in frame.columns if c not in table.columns])


def publish_version(
    frame: DataFrame, root: str, version: str, partition_by: Sequence[str] = (), keep: int = 3
) -> str:
    """Write a table into a folder of its own under ``root`` and return its path.

    Readers take the last complete version (``current_version``), so they never
    meet a half-written table; a retry replaces its own version. The last
    ``keep`` versions stay.
    """
    spark = frame.sparkSession
    publish(frame, f"{root}/{version}", partition_by=partition_by)
    for old in complete_versions(spark, root)[:-keep]:
        remove_path(spark, f"{root}/{old}")
    return f"{root}/{version}"


def complete_versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the versions that were written to the end, oldest first."""
    return [name for name in child_names(spark, root) if "_SUCCESS" in child_names(spark, f"{root}/{name}")]


def current_version(spark: SparkSession, root: str) -> DataFrame:
    """The last complete version of a table."""
    return spark.read.parquet(f"{root}/{complete_versions(spark, root)[-1]}")


def create_if_absent(spark: SparkSession, table: Table, partition_by: Sequence[str] = ()) -> None:
    """Empty catalog table with the declared columns and comments; no effect when it exists."""

    def column(field) -> str:
        comment = field.metadata.get("comment")
        suffix = f" COMMENT '{comment}'" if comment else ""
        return f"`{field.name}` {field.dataType.simpleString()}{suffix}"

    columns = ", ".join(column(field) for field in table.schema.fields)
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    comment = f" COMMENT '{table.comment}'" if table.comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING parquet{layout}{comment}")


def replace_table(frame: DataFrame, table: Table, columns_last: Sequence[str] = ()) -> None:
    """Replace all rows of a catalog table (truncate and insert).

    ``columns_last`` names its partition columns, which a catalog table keeps
    behind the others.
    """
    ordered = [c for c in table.columns if c not in columns_last] + list(columns_last)
    typed = frame.select(*[frame[c].cast(table.schema[c].dataType) for c in ordered])
    typed.write.insertInto(table.name, overwrite=True)
