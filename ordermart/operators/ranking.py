"""Global row numbers and tiles without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.session import ensure_checkpoint_dir

#: Ranges in which the rows around the end of a tile are counted at a time.
STEPS = 1 << 12
#: Accuracy of the quantile sketch from which the search starts; no result depends on it.
ACCURACY = 10_000
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the in-partition position in the low 33 bits


def with_row_number(frame: DataFrame, order: Sequence[Column], name: str, total: str | None = None) -> DataFrame:
    """Exact global ``row_number`` by ``order``; optionally the row count in ``total``.

    ``Window.orderBy`` without a partition moves every row into one task. Here
    a range-partitioned sort gives each row (partition, position); a row's
    number is its position plus the sizes of the earlier partitions. ``order``
    must end in a unique column: this makes the result repeatable, and lets the
    sort cut a run of equal values into several partitions.

    The sorted rows are checkpointed, since a recomputed range sort may cut its
    partitions elsewhere. The offsets frame has one row per sort partition.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    placed = frame.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", _LOCAL_BITS)
    position = F.col("_at").bitwiseAND((1 << _LOCAL_BITS) - 1)

    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(everything).alias("_total"),
    )
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    columns = [*frame.columns, (F.col("_offset") + position + 1).alias(name)]
    if total:
        columns.append(F.col("_total").alias(total))
    return numbered.select(*columns)


def with_ntile(frame: DataFrame, tiles: int, order: Sequence[Column], name: str) -> DataFrame:
    """Exact global ``NTILE(tiles)`` by ``order``, whose last column must be unique."""
    numbered = with_row_number(frame, order, "_number", total="_rows")
    tile = _tile(F.col("_number") - 1, F.col("_rows"), tiles)
    return numbered.select(*frame.columns, tile.alias(name))


def first_with_ntile(frame: DataFrame, tiles: int, order: Sequence[Column], name: str, limit: int) -> DataFrame:
    """The first ``limit`` rows by ``order``, each with its ``NTILE(tiles)`` among all rows.

    Their numbers are 1 to ``limit``, so the row count is all that is needed of
    the rest: no global sort. The frame is checkpointed, since it is read for
    the count and for the first rows.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    kept = frame.checkpoint()
    rows = kept.agg(F.count(F.lit(1))).scalar()
    numbered = kept.orderBy(*order).limit(limit).withColumn("_number", F.row_number().over(Window.orderBy(*order)))
    return numbered.select(*frame.columns, _tile(F.col("_number") - 1, rows, tiles).alias(name))


def ntile_scores(frame: DataFrame, key: str, scores: Mapping[str, Column], tiles: int) -> DataFrame:
    """Several global ``NTILE`` scores of the same rows, without sorting them.

    ``scores`` maps each name to the BIGINT that orders it, ascending, nulls
    first; the unique ``key`` breaks ties. A row's tile is the number of tiles
    that end before it, so all that is needed of the order is the last row of
    every tile but the last (``tile_ends``); each row is then compared with these
    ``tiles - 1`` rows per score where it lies, without a join or a shuffle.
    Returns ``key`` and, per score, its tile and its value as ``<name>_value``.

    The rows are checkpointed, since they are read a few times: once per step of
    the search for the ends, and once for the result.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    valued = frame.select(key, *[value.cast("bigint").alias(f"{name}_value") for name, value in scores.items()]).checkpoint()
    ends = tile_ends(valued, key, [f"{name}_value" for name in scores], tiles)

    def tile(name: str) -> Column:
        value = F.col(f"{name}_value")
        after = [F.lit(1)]
        for last, last_key in ends[f"{name}_value"]:
            if last is None:
                beyond, same = value.isNotNull(), value.isNull()
            else:
                beyond, same = F.coalesce(value > F.lit(last), F.lit(False)), value.eqNullSafe(F.lit(last))
            if last_key is not None:
                beyond = beyond | (same & (F.col(key) > F.lit(last_key)))
            after.append(beyond.cast("int"))
        return reduce(Column.__add__, after)

    return valued.select(key, *[column for name in scores for column in (tile(name).alias(name), F.col(f"{name}_value"))])


def tile_ends(
    valued: DataFrame, key: str, columns: Sequence[str], tiles: int
) -> dict[str, list[tuple[int | None, object]]]:
    """(value, key) of the last row of every tile but the last, per column; the key is None where all rows of the value belong.

    Each column is ordered ascending, nulls first, ties by the unique key; an end of a
    tile that holds no row is left out. The value of an end is first guessed from a
    quantile sketch, and the rows around the guess are counted; where it is not the end,
    it is found by counting rows in up to ``STEPS`` equal ranges, then in the parts of the range that holds
    the end, until a range is one value: one to six aggregations whose results are as
    small as the number of ranges. Only rows that share the value of an end in
    their midst are numbered by key.
    """
    shares = F.lit([tile / tiles for tile in range(1, tiles)] or [0.5])
    bounds = valued.agg(
        F.count(F.lit(1)),
        *[f for c in columns for f in (F.count(c), F.min(c), F.max(c), F.percentile_approx(c, shares, F.lit(ACCURACY)))],
    ).first()
    rows, found, searches, guesses = bounds[0], {c: [] for c in columns}, [], []
    for i, column in enumerate(columns):
        present, low, high, near = bounds[1 + 4 * i:5 + 4 * i]
        for tile in range(1, tiles):
            last = tile * (rows // tiles) + min(tile, rows % tiles)  # number of the last row of the tile
            if not last or last >= rows:
                continue
            slot = len(found[column])
            found[column].append((None, None))
            if last > rows - present:
                searches.append(_Search(column, slot, last, rows - present, low, high))
                guesses.append(near[min(len(near) - 1, (last - rows + present) * tiles // max(present, 1))])
            elif last < rows - present:
                searches.append(_Search(column, slot, last, 0, None, None, rows - present))
                guesses.append(None)
    _try(valued, [(s, guess) for s, guess in zip(searches, guesses) if s.low != s.high])
    while any(s.low != s.high for s in searches):
        _narrow(valued, [s for s in searches if s.low != s.high])
    for s in searches:
        found[s.column][s.slot] = (s.low, None)
    single = [s for s in searches if s.held is None]
    if single:  # ranges of one value from the start, or left of a guess
        counted = valued.agg(*[F.count_if(F.col(s.column) == F.lit(s.low)) for s in single]).first()
        for s, held in zip(single, counted):
            s.held = held
    open_ones = [s for s in searches if s.number - s.before < s.held]
    for s, last_key in zip(open_ones, _keys_at(valued, key, open_ones)):
        found[s.column][s.slot] = (s.low, last_key)
    return found


@dataclass
class _Search:
    """The row of a number in the order of a column: its value lies from ``low`` to ``high``."""

    column: str
    slot: int
    number: int
    before: int  # rows before those of the range
    low: int | None
    high: int | None
    held: int | None = None  # rows of the range, where known


def _try(valued: DataFrame, guesses: Sequence[tuple[_Search, int]]) -> None:
    """Cut the range of every search to its guess, or to the side of it where the row lies, by one aggregation."""
    if not guesses:
        return
    counted = valued.agg(*[
        F.count_if(c) for s, guess in guesses for c in (F.col(s.column) < F.lit(guess), F.col(s.column) == F.lit(guess))
    ]).first()
    for i, (s, guess) in enumerate(guesses):
        below, held = s.before + counted[2 * i], counted[2 * i + 1]
        if s.number <= below:
            s.high = guess - 1
        elif s.number <= below + held:
            s.low, s.high, s.before, s.held = guess, guess, below, held
        else:
            s.low, s.before = guess + 1, below + held


def _narrow(valued: DataFrame, searches: Sequence[_Search]) -> None:
    """Cut the range of every search to one of at most ``STEPS`` parts of it, by one aggregation.

    Parts are multiples of a power of two, so a row's part is its value without the low bits.
    """
    bits = [next(b for b in range(64) if (s.high >> b) - (s.low >> b) < STEPS) for s in searches]
    places = F.array_compact(F.array(*[
        F.when(F.col(s.column).between(s.low, s.high), F.struct(
            F.lit(i).alias("search"), F.shiftright(s.column, b).alias("part")
        )) for i, (s, b) in enumerate(zip(searches, bits))
    ]))
    counted = valued.select(F.explode(places).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("held"))
    by_search: dict[int, list[tuple[int, int]]] = {}
    for r in counted.select("at.search", "at.part", "held").collect():  # at most STEPS rows for each search
        by_search.setdefault(r.search, []).append((r.part, r.held))
    for i, (s, b) in enumerate(zip(searches, bits)):
        for part, held in sorted(by_search[i]):
            if s.before + held >= s.number:
                s.low, s.high, s.held = max(s.low, part << b), min(s.high, (part + 1 << b) - 1), held
                break
            s.before += held


def _keys_at(valued: DataFrame, key: str, searches: Sequence[_Search]) -> list:
    """Key of the row at the number of each search, among the rows of its value."""
    if not searches:
        return []
    values = list(dict.fromkeys((s.column, s.low) for s in searches))  # several tiles may end in one value
    of = F.array_compact(F.array(*[
        F.when(F.col(column).eqNullSafe(F.lit(value).cast("bigint")), F.lit(i)) for i, (column, value) in enumerate(values)
    ]))
    tied = valued.select(F.explode(of).alias("_of"), key)
    held = {(s.column, s.low): s.held for s in searches}
    before = [sum(held[v] for v in values[:i]) for i in range(len(values))]
    wanted = [before[values.index((s.column, s.low))] + s.number - s.before for s in searches]
    numbered = with_row_number(tied, [F.col("_of").asc(), F.col(key).asc()], "_number")
    at = {r["_number"]: r[key] for r in numbered.filter(F.col("_number").isin(wanted)).collect()}
    return [at[number] for number in wanted]


def _tile(zero_based: Column, rows: Column, tiles: int) -> Column:
    """Tile of a row: the first ``rows % tiles`` tiles hold one row more than the others."""
    small = F.call_function("div", rows, F.lit(tiles))
    extra = rows % tiles
    in_large = extra * (small + 1)  # rows that lie in the larger tiles
    tile = F.when(zero_based < in_large, F.call_function("div", zero_based, small + 1)).otherwise(
        # small is 0 only when every row lies in a larger tile
        extra + F.call_function("div", zero_based - in_large, F.greatest(small, F.lit(1)))
    )
    return (tile + 1).cast("int")
