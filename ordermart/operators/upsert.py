"""Insert-or-update of keyed tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """All target rows plus new keys; a key on both sides takes only ``update`` from incoming.

    Keys must be unique on either side. Null key parts match each other.
    """
    same = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
    in_old, in_new = F.col("old._here").isNotNull(), F.col("new._here").isNotNull()
    joined = (
        target.withColumn("_here", F.lit(1)).alias("old")
        .join(incoming.withColumn("_here", F.lit(1)).alias("new"), same, "full_outer")
    )

    def choose(column: str):
        if column in update:
            take_new = in_new
        else:
            take_new = ~in_old
        return F.when(take_new, F.col(f"new.{column}")).otherwise(F.col(f"old.{column}")).alias(column)

    return joined.select(*[choose(column) for column in target.columns])
