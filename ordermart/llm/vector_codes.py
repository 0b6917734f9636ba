"""Vector codes: product quantisation whose nearest entries are found by Orchard's search.

Vectors are cut into equal consecutive parts; each part position has a codebook. The
nearest entry of a part is found in the lists of neighbours that every entry keeps,
sorted by distance. A search walks the list of its current entry, marks the entries it
has measured, jumps to the list of an entry that is nearer, and stops at the first
neighbour more than twice as far from the current entry as the part is: by the
triangle inequality no later one can be nearer, nor as near. All distances are whole
numbers, so ties are exact.

The codebooks are refined in rounds. A task assigns its parts and adds them up by entry
and position; only these sums, at most one for each codebook component and task, are
shuffled. The driver holds the codebooks, which are as large as ``entries`` vectors,
however many rows there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components beyond this have squared distances that 64 bits may not hold.
LIMIT = 1 << 24
_ROWS = 4096  # vectors searched at a time


# ---- search ----------------------------------------------------------------

class Codebook:
    """Entries of one part position, with the other entries of each sorted by distance."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.near = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.near, axis=1)
        # Searches start at the entry that is nearest by the sum of its components.
        self.by_sum = np.argsort(entries.sum(axis=1), kind="stable")
        self.sums = entries.sum(axis=1)[self.by_sum]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of the nearest entry of each part; the lowest of several."""
        n, k = len(parts), len(self.entries)
        spot = np.searchsorted(self.sums, parts.sum(axis=1))
        current = self.by_sum[np.minimum(spot, k - 1)]
        distance = ((parts - self.entries[current]) ** 2).sum(axis=1)
        visited = np.zeros((n, k), bool)
        visited[np.arange(n), current] = True
        place = np.zeros(n, np.int64)  # in the list of the current entry
        walking = np.arange(n)
        while len(walking):
            at = place[walking]
            going = at < k
            going[going] = self.apart[current[walking[going]], at[going]] <= 4 * distance[walking[going]]
            walking = walking[going]
            entry = self.near[current[walking], place[walking]]
            place[walking] += 1
            fresh = ~visited[walking, entry]
            row, entry = walking[fresh], entry[fresh]
            visited[row, entry] = True
            measured = ((parts[row] - self.entries[entry]) ** 2).sum(axis=1)
            better = (measured < distance[row]) | (measured == distance[row]) & (entry < current[row])
            row, entry, measured = row[better], entry[better], measured[better]
            current[row], distance[row], place[row] = entry, measured, 0
        return current, distance


def _codebooks(entries: np.ndarray) -> list[Codebook]:
    return [Codebook(part) for part in entries]


def _assigned(vectors: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances) of the parts of the vectors, a column for each part position."""
    parts = np.split(vectors, len(books), axis=1)
    found = [book.nearest(np.ascontiguousarray(part)) for book, part in zip(books, parts)]
    return np.column_stack([e for e, _ in found]), np.column_stack([d for _, d in found])


def _blocks(batch: pd.DataFrame, dims: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for low in range(0, len(batch), _ROWS):
        part = batch.iloc[low:low + _ROWS]
        yield part, np.concatenate(part["whole"].to_numpy()).reshape(len(part), dims)


# ---- rows ------------------------------------------------------------------

def _finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


def _refined(entries: np.ndarray, sums: pd.DataFrame) -> np.ndarray:
    entries = entries.copy()
    for r in sums.itertuples():
        entries[r.part, r.entry] = [int(s) // int(r.number) for s in r.sums]
    return entries


def vector_codes(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of every usable row, and the codebooks (part, entry, component).

    Rows whose vector is null, or holds a null or a component that is not finite, are
    left out. Components are scaled and rounded down to whole numbers. The codebooks
    start as the parts of the ``entries`` rows with the smallest identifiers (of equal
    identifiers by vector; rows without one come last), fewer if there are fewer rows,
    and every round replaces an entry by the mean of its parts, rounded down.

    ``code`` lists the entry of each part, ``error`` adds up their squared distances.
    The first row, by identifier, whose length is a positive multiple of ``parts`` sets
    the length; rows of another length, or with a scaled component beyond ``LIMIT``,
    have a null code and error and do not take part in the codebooks. Repeated rows
    count as often as they occur. An empty table gives an empty result and no codebooks;
    other columns are ignored. At most 256 entries fit a code of one byte a part.
    """
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("a code has at least one part, and 1 to 256 entries")
    column = F.col(f"`{vector_col}`").cast("array<double>")
    kept = vectors.where(_finite(column)).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
        F.transform(column, lambda x: F.floor(x * scale)).alias("whole"),
        F.forall(column, lambda x: F.abs(x * scale) < LIMIT).alias("fits"),
    )
    order = [F.col("id").asc_nulls_last(), F.col("whole").asc()]
    usable = kept.where(F.col("fits") & (F.size("whole") > 0) & (F.size("whole") % parts == 0))
    first = usable.orderBy(*order).select("whole").limit(1).collect()
    id_kind, label_kind = kept.schema["id"].dataType, kept.schema["label"].dataType
    if not first:
        nothing = [F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error")]
        return kept.select(F.col("id").alias(id_col), F.col("label").alias(label_col), *nothing), np.empty((0, 0, 0), np.int64)
    dims = len(first[0]["whole"])
    like = F.col("fits") & (F.size("whole") == dims)
    start = [r["whole"] for r in kept.where(like).orderBy(*order).select("whole").limit(entries).collect()]
    book = np.array(start, np.int64).reshape(len(start), parts, -1).swapaxes(0, 1)

    for _ in range(rounds):
        def summed(batches: Iterator[pd.DataFrame], book: np.ndarray = book) -> Iterator[pd.DataFrame]:
            books = _codebooks(book)
            sums, numbers = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
            for batch in batches:
                for _, whole in _blocks(batch, dims):
                    chosen, _ = _assigned(whole, books)
                    for part, values in enumerate(np.split(whole, parts, axis=1)):
                        np.add.at(sums[part], chosen[:, part], values)
                        numbers[part] += np.bincount(chosen[:, part], minlength=len(numbers[part]))
            part, entry = np.nonzero(numbers)
            if len(part):
                yield pd.DataFrame(
                    {"part": part, "entry": entry, "number": numbers[part, entry], "sums": list(sums[part, entry])}
                )

        partial = kept.where(like).select("whole").mapInPandas(summed, "part int, entry int, number long, sums array<long>")
        total = partial.groupBy("part", "entry").agg(
            F.sum("number").alias("number"),
            F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(dims // parts)]).alias("sums"),
        )
        book = _refined(book, total.toPandas())  # one row for each codebook entry in use

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books = _codebooks(book)
        for batch in batches:
            for rows, whole in _blocks(batch, dims):
                chosen, distances = _assigned(whole, books)
                yield pd.DataFrame({
                    "id": rows["id"].to_numpy(), "label": rows["label"].to_numpy(), "code": list(chosen),
                    "error": distances.sum(axis=1),
                })

    # As text, identifiers and labels pass pandas unchanged, nulls among them or not.
    as_text = [F.col("id").cast("string").alias("id"), F.col("label").cast("string").alias("label")]
    fitting = kept.where(like).select(*as_text, "whole").mapInPandas(coded, "id string, label string, code array<int>, error long")
    fitting = fitting.select(F.col("id").cast(id_kind).alias("id"), F.col("label").cast(label_kind).alias("label"), "code", "error")
    others = kept.where(~like).select("id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
    found = fitting.unionByName(others)
    return found.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error"), book


def with_label_error(codes: DataFrame, *, label_col: str = "label", error_col: str = "error") -> DataFrame:
    """``codes`` with ``label_error``, the error added up over the rows of the same label; nulls are one label.

    Rows are added up by label before they are shuffled; the sums are joined back in a
    way that Spark can split for a label of many rows.
    """
    codes = stored(codes, "codes")
    sums = stored(codes.groupBy(F.col(label_col).alias("__of")).agg(F.sum(error_col).alias("label_error")), "label_errors")
    return codes.join(sums, F.col(label_col).eqNullSafe(F.col("__of")), "left").drop("__of")


def codebooks_digest(book: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
