"""Keep the first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(frame: DataFrame, key: str | Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, or by all other columns; nulls come last.

    Partitions have no file order, so "first" must be a stated order. Spark
    limits each map task to its own first row per key before the shuffle
    (``WindowGroupLimit``), so a key with very many copies reaches the reducer
    as one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranking = list(order) if order is not None else [c for c in frame.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in ranking or keys]
    )
    return frame.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
