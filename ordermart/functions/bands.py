"""Banding and conditional labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Consecutive intervals; ``edges`` has one entry more than ``labels``.

    An infinite last edge leaves the top interval open.
    """

    edges: Sequence[float]
    labels: Sequence[str]
    right_closed: bool = True

    def __post_init__(self) -> None:
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("need exactly one edge more than labels")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("edges must increase")


def band(column: Column, bands: Bands) -> Column:
    """Label of the interval holding the value; null outside all intervals and for null."""

    def inside(low: float, high: float) -> Column:
        above = column > _edge(low) if bands.right_closed else column >= _edge(low)
        if high == float("inf"):
            return above
        return above & (column <= _edge(high) if bands.right_closed else column < _edge(high))

    pairs = zip(bands.edges, bands.edges[1:], bands.labels)
    return labelled([(inside(low, high), label) for low, high, label in pairs])


def labelled(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """First rule that holds gives the label; a null condition does not hold."""
    first, *rest = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(default).cast("string"))


def _edge(value: float) -> Column:
    # Decimal text keeps 4.2 exactly 4.2 when compared with a DECIMAL rating.
    return F.lit(Decimal(str(value)))
