"""Partitioned tables whose versions share the partitions that did not change.

A version writes its partitions under a folder of its own and then a manifest: the
list of all partitions of the table with the version that holds each of them. Readers
take the last complete manifest and read the folders it names, so what they see
changes at once when the manifest is complete, and not at all when a version fails.

    root/data/_version=<v>/<partition>/part-….parquet
    root/manifests/<v>/                                 (partition, version), one row each

A manifest is as long as the table has partitions. Writers of one table must take turns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.operators.upsert import upsert
from ordermart.session import child_names, ensure_checkpoint_dir, remove_path
from ordermart.sources.writers import complete_versions, publish

VERSION = "_version"
_MANIFEST = "partition string, version string"


def manifest(spark: SparkSession, root: str, version: str | None = None) -> dict[str, str]:
    """Partition folder -> version that holds it, of a version or of the last complete one; empty without any."""
    complete = complete_versions(spark, f"{root}/manifests")
    if not complete:
        return {}
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifests/{version or complete[-1]}").collect()
    return {r.partition: r.version for r in rows}


def _leaves(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders ``a=1/b=2`` below ``folder``."""
    names = [name for name in child_names(spark, folder) if "=" in name]
    if depth == 1:
        return names
    return [f"{name}/{rest}" for name in names for rest in _leaves(spark, f"{folder}/{name}", depth - 1)]


def read_versioned(spark: SparkSession, root: str, schema: T.StructType, version: str | None = None) -> DataFrame:
    """The table as of a version, by default the last complete one; empty where there is none."""
    held = manifest(spark, root, version)
    if not held:
        return spark.createDataFrame([], schema)
    data = f"{root}/data"
    whole = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    paths = [f"{data}/{VERSION}={v}/{partition}" for partition, v in sorted(held.items())]
    return spark.read.schema(whole).option("basePath", data).parquet(*paths).select(*schema.fieldNames())


def write_versioned(
    frame: DataFrame, root: str, version: str, partition_by: Sequence[str], keep_others: bool = False, keep: int = 3,
    without: Sequence[str] = (),
) -> None:
    """Make ``frame`` a version of the table: all of it, or with ``keep_others`` the partitions it touches.

    Other partitions named in ``without`` (as folders ``a=1/b=2``) leave the table.

    A retry of a version replaces what the version has written. The last ``keep``
    versions can still be read; data that only earlier ones named is removed.
    """
    spark = frame.sparkSession
    others = manifest(spark, root) if keep_others else {}
    publish(frame, f"{root}/data/{VERSION}={version}", partition_by=partition_by)
    touched = _leaves(spark, f"{root}/data/{VERSION}={version}", len(partition_by))
    held = {p: v for p, v in others.items() if p not in set(without)} | dict.fromkeys(touched, version)
    listed = spark.createDataFrame(sorted(held.items()), _MANIFEST)
    publish(listed.coalesce(1), f"{root}/manifests/{version}")
    _remove_unnamed(spark, root, len(partition_by), keep)


def _remove_unnamed(spark: SparkSession, root: str, depth: int, keep: int) -> None:
    complete = complete_versions(spark, f"{root}/manifests")
    for old in complete[:-keep]:
        remove_path(spark, f"{root}/manifests/{old}")
    named = {(v, p) for version in complete[-keep:] for p, v in manifest(spark, root, version).items()}
    for folder in child_names(spark, f"{root}/data"):
        version = folder.removeprefix(f"{VERSION}=")
        if version > complete[-1]:
            continue  # another writer's, not complete yet
        leaves = _leaves(spark, f"{root}/data/{folder}", depth)
        gone = [p for p in leaves if (version, p) not in named]
        for partition in gone:
            remove_path(spark, f"{root}/data/{folder}/{partition}")
        if len(gone) == len(leaves):
            remove_path(spark, f"{root}/data/{folder}")


def _touched(incoming: DataFrame, partition_by: Sequence[str]) -> Column:
    """The partitions of ``incoming``, as values that prune the folders to read; a row for each partition is collected."""
    values = incoming.select(*partition_by).distinct().collect()
    each = [
        reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c]).cast(incoming.schema[c].dataType)) for c in partition_by])
        for r in values
    ]
    return reduce(Column.__or__, each, F.lit(False))


def upsert_versioned(
    incoming: DataFrame, root: str, version: str, keys: Sequence[str], update: Sequence[str], partition_by: Sequence[str],
    keep: int = 3,
) -> None:
    """Upsert into a versioned table (see ``upsert``): only partitions that ``incoming`` touches are read and written.

    ``partition_by`` must be part of ``keys``. An absent table is created. Incoming rows
    are checkpointed because they are read twice.
    """
    spark = incoming.sparkSession
    ensure_checkpoint_dir(spark)
    incoming = incoming.checkpoint()
    affected = read_versioned(spark, root, incoming.schema).filter(_touched(incoming, partition_by))
    write_versioned(upsert(affected, incoming, keys, update), root, version, partition_by, keep_others=True, keep=keep)
