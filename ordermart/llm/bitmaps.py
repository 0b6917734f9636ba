"""Bitmaps of hashed keys, small enough to send to every task, that keep most rows out of a join."""

from __future__ import annotations

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 64 for each key, within these bounds (128 KB and 16 MB).
MIN_BITS, MAX_BITS = 1 << 20, 1 << 27


def bitmap(frame: DataFrame, key: Column) -> Broadcast:
    """A bit for every 64-bit ``key`` of ``frame``; however many keys there are, 16 MB at most.

    A fuller bitmap lets more keys through that ``frame`` does not hold, so whoever
    asks it joins exactly afterwards.
    """
    bits, number = MIN_BITS, frame.count()
    while bits < min(MAX_BITS, 64 * number):
        bits *= 2
    place = F.pmod(key, F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = (
        frame.select(F.floor(place / 64).alias("word"), one.alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    held = np.zeros(bits // 64, np.uint64)
    held[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return frame.sparkSession.sparkContext.broadcast(held)


def holds(held: np.ndarray, key: int) -> bool:
    """Whether the bit of an unsigned key is set."""
    spot = key & (64 * len(held) - 1)
    return bool((int(held[spot >> 6]) >> (spot & 63)) & 1)
