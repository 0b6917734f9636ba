"""Large frames cut by key, so that a write shuffles a part of its rows at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of input up to which a frame is not cut, and after which one slice more is made.
SLICE_BYTES = 64 << 20
#: Every slice reads the whole input, so there are no more than these.
MOST = 6
_UNKNOWN = 1 << 60  # Spark's size of what it can't measure is larger


def input_bytes(*frames: DataFrame) -> int:
    """Bytes of the tables behind ``frames``, each once; those without a known size are left out."""
    seen, total = [], 0
    for frame in frames:
        leaves = frame._jdf.queryExecution().analyzed().collectLeaves()
        for i in range(leaves.size()):
            size, table = leaves.apply(i).stats().sizeInBytes(), leaves.apply(i).canonicalized()
            if size < _UNKNOWN and not any(table.equals(other) for other in seen):
                seen.append(table)
                total += size
    return total


def slice_count(*frames: DataFrame, most: int = MOST) -> int:
    """Number of slices by the size of the input of ``frames``; one for small tables."""
    return max(1, min(most, -(-input_bytes(*frames) // SLICE_BYTES)))


def slices(key: str, number: int) -> list[Column]:
    """Conditions on ``key`` that cut a frame, or several that hold the key in one type alike, into slices.

    All rows of a key, null included, meet exactly one condition, so what is computed by
    key in each slice adds up to what is computed of the whole.
    """
    if number == 1:
        return [F.lit(True)]
    return [F.pmod(F.xxhash64(key), F.lit(number)) == i for i in range(number)]
