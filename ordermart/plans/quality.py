"""Audits: source gate, profiles, constraints. Each returns a small frame of findings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.functions.exact import percentage
from ordermart.schemas import MINIMUM_ROWS, STAR, Table


class GateFailed(ValueError):
    """At least one source is missing or too short."""


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _unpivot(one_row: DataFrame, cells: list[tuple[list[Column], Column]], names: list[str], value: str) -> DataFrame:
    """One row of aggregates to one row per aggregate."""
    structs = [
        F.struct(*[label.alias(n) for label, n in zip(labels, names)], cell.alias(value)) for labels, cell in cells
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("_cell")).select("_cell.*")


# ---- source gate -----------------------------------------------------------

def source_gate(
    spark: SparkSession, sources: Mapping[str, DataFrame | None], minimums: Mapping[str, int] = MINIMUM_ROWS
) -> DataFrame:
    """Row count of every source against its minimum; a missing source has a null count."""

    def counted(name: str, frame: DataFrame | None) -> DataFrame:
        if frame is None:
            rows = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        else:
            rows = frame.agg(F.count(F.lit(1)).alias("row_count"))
        return rows.select(F.lit(name).alias("source"), "row_count", F.lit(minimums[name]).alias("min_rows"))

    return _judged(_union([counted(name, sources.get(name)) for name in minimums]))


def counted_gate(
    spark: SparkSession, counts: Mapping[str, int | None], minimums: Mapping[str, int] = MINIMUM_ROWS
) -> DataFrame:
    """The same from row counts that were taken while the sources were read; None for a missing source."""
    rows = [(name, counts.get(name), least) for name, least in minimums.items()]
    return _judged(spark.createDataFrame(rows, "source string, row_count bigint, min_rows int"))


def _judged(gate: DataFrame) -> DataFrame:
    outcome = (
        F.when(F.col("row_count").isNull(), "MISSING")
        .when(F.col("row_count") < F.col("min_rows"), "LOW ROWS")
        .otherwise("OK")
    )
    return gate.withColumn("outcome", outcome)


def require_gate(gate: DataFrame) -> None:
    """Raise once, naming every source that failed. The frame has one row per source."""
    failed = gate.filter(F.col("outcome") != "OK").orderBy("source").collect()
    if failed:
        lines = [f"{r.outcome}: {r.source} has {r.row_count}, needs {r.min_rows}" for r in failed]
        raise GateFailed("source gate failed:\n" + "\n".join(lines))


# ---- profiles --------------------------------------------------------------

def null_profile(name: str, frame: DataFrame) -> DataFrame:
    """Percent of nulls per column, for columns that have any; one pass."""
    counts = frame.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns]
    )
    cells = [([F.lit(name), F.lit(c)], percentage(F.col(c), F.col("_rows"))) for c in frame.columns]
    return _unpivot(counts, cells, ["table_name", "column_name"], "null_pct").filter(F.col("null_pct") > 0)


def duplicate_profile(name: str, frame: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full.

    The frame is read once, and its whole rows are shuffled once, to be compared.
    """
    copies = frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("_rows"))
    return copies.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_rows"),
    ).select(F.lit(name).alias("table_name"), "row_count", "duplicate_rows")


def null_profiles(frames: Mapping[str, DataFrame]) -> DataFrame:
    return _union(null_profile(name, frame) for name, frame in frames.items())


def duplicate_profiles(frames: Mapping[str, DataFrame]) -> DataFrame:
    return _union(duplicate_profile(name, frame) for name, frame in frames.items())


# ---- declared constraints --------------------------------------------------

def not_null_audit(frames: Mapping[str, DataFrame], tables: Mapping[str, Table] = STAR) -> DataFrame:
    """Nulls in every column declared as required."""

    def audit(table: Table) -> DataFrame:
        counts = frames[table.name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.required])
        cells = [([F.lit(table.name), F.lit(c)], F.col(c)) for c in table.required]
        return _unpivot(counts, cells, ["table_name", "column_name"], "null_rows")

    return _union(audit(tables[name]) for name in frames if tables[name].required)


def repeated_keys(frame: DataFrame, key: Iterable[str]) -> DataFrame:
    """Keys held by more than one row."""
    return frame.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def key_audit(frames: Mapping[str, DataFrame], tables: Mapping[str, Table] = STAR) -> DataFrame:
    """Repeated primary and unique keys per table."""

    def audit(table: Table, key: tuple[str, ...]) -> DataFrame:
        return repeated_keys(frames[table.name], key).agg(
            F.count(F.lit(1)).alias("repeated_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra_rows"),
        ).select(
            F.lit(table.name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
            "repeated_keys", "extra_rows",
        )

    checks = [(tables[n], key) for n in frames for key in (tables[n].key, *[(u,) for u in tables[n].unique])]
    return _union(audit(table, key) for table, key in checks)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of ``column`` without a parent row, and how many child rows hold them; null counts as one.

    Child rows are counted per value first, so a heavy value meets the join as one row.
    """
    held = child.groupBy(column).agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(F.col(parent_key).alias(column))
    return held.join(known, column, "left_anti")


def foreign_key_audit(frames: Mapping[str, DataFrame], tables: Mapping[str, Table] = STAR) -> DataFrame:
    """Orphans of every declared foreign key."""

    def audit(table: Table, column: str, parent: Table) -> DataFrame:
        lost = orphans(frames[table.name], column, frames[parent.name], parent.key[0])
        return lost.agg(
            F.count(column).alias("orphan_keys"),
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows"),
            F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("child_rows"))), F.lit(0)).alias("null_rows"),
        ).select(
            F.lit(table.name).alias("table_name"), F.lit(column).alias("column_name"),
            F.lit(parent.name).alias("parent_table"), "orphan_keys", "orphan_rows", "null_rows",
        )

    checks = [(tables[n], c, tables[p]) for n in frames for c, p in tables[n].foreign.items()]
    return _union(audit(*check) for check in checks)


def flag_mismatches(orders: DataFrame) -> DataFrame:
    """Orders flagged as delivered under another status."""
    return orders.filter((F.col("is_delivered") == 1) & (F.col("status") != "Delivered")).select("order_id", "status")


def domain_audit(frames: Mapping[str, DataFrame], tables: Mapping[str, Table] = STAR) -> DataFrame:
    """Values longer than their declared length, or outside their declared precision."""

    def rules(table: Table) -> list[tuple[str, str, Column]]:
        found = [
            (c, f"length <= {n}", F.length(F.col(c).cast("string")) > n) for c, n in table.lengths.items()
        ]
        for field in table.schema.fields:
            if isinstance(field.dataType, T.DecimalType):
                kind = field.dataType.simpleString()
                value = F.col(field.name)
                found.append((field.name, kind, value.isNotNull() & value.try_cast(kind).isNull()))
        return found

    def audit(table: Table) -> DataFrame:
        checks = rules(table)
        counts = frames[table.name].agg(
            *[F.count_if(violated).alias(f"_{i}") for i, (_, _, violated) in enumerate(checks)]
        )
        cells = [
            ([F.lit(table.name), F.lit(column), F.lit(rule)], F.col(f"_{i}"))
            for i, (column, rule, _) in enumerate(checks)
        ]
        return _unpivot(counts, cells, ["table_name", "column_name", "rule"], "violations")

    return _union(audit(tables[n]) for n in frames if rules(tables[n]))


def findings(sources: Mapping[str, DataFrame], star: Mapping[str, DataFrame], tables: Mapping[str, Table] = STAR) -> DataFrame:
    """Everything the profiles of the sources and the constraints of the star have found.

    One row per finding: ``finding``, ``table_name``, ``subject`` and ``amount``,
    a percentage for nulls of the sources and a number of rows otherwise. Orders
    outside the calendar are orphans of ``date_id``.
    """

    def found(kind: str, frame: DataFrame, subject: Column, amount: str) -> DataFrame:
        return frame.select(
            F.lit(kind).alias("finding"), "table_name", subject.alias("subject"),
            F.col(amount).cast("double").alias("amount"),
        ).filter(F.col("amount") > 0)

    orders = star["fact_orders"]
    flags = flag_mismatches(orders).agg(F.count(F.lit(1)).alias("violations")).withColumn("table_name", F.lit("fact_orders"))
    return _union([
        found("source nulls", null_profiles(sources), F.col("column_name"), "null_pct"),
        found("source duplicates", duplicate_profiles(sources), F.lit("whole row"), "duplicate_rows"),
        found("not null", not_null_audit(star, tables), F.col("column_name"), "null_rows"),
        found("foreign key", foreign_key_audit(star, tables), F.col("column_name"), "orphan_rows"),
        found("domain", domain_audit(star, tables), F.concat_ws(" ", "column_name", "rule"), "violations"),
        found("flag", flags, F.lit("is_delivered"), "violations"),
    ])


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in frames.items()
    )
