"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, name: str) -> DataFrame:
    """Every edge (u, v) with the least v of its u."""
    return edges.join(stored(edges.groupBy("u").agg(F.min("v").alias("least")), f"{name}_least"), "u")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the undirected edges; component is the least node.

    Edges with a null end and loops are ignored; loops alone make no component.
    Every round writes its edges to the shared folder; the number of rounds grows
    with the logarithm of the number of nodes. Nodes of a high degree are met by
    a minimum that is taken before the shuffle and by a join that Spark can split.
    """
    first = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    current, before = stored(first, "edges"), None
    while (now := _signature(current)) != before:
        before = now
        both = stored(current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large = stored(
            _star(both, "large").where("v > u").select(F.col("v").alias("u"), F.least("least", "u").alias("v")).distinct(),
            "large",
        )
        small = _star(large, "small")
        current = stored(
            small.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(small.select("u", F.col("least").alias("v"))).distinct(),
            "edges",
        )
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
