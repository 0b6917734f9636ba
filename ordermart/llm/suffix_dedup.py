"""Suffix-array dedup: passages of a given length that start more than once.

The corpus is dealt to shards in such a way that equal passages meet:

* Among the k-gram hashes inside a window of ``length`` bytes the least one is
  its anchor. Equal windows have equal anchors, and the windows of neighbouring
  starts mostly share theirs, so a text falls into stretches of starts with one
  anchor each.
* A stretch whose anchor occurs nowhere else holds no repeated window. Of the
  others the bytes (the context) go to the shard of the anchor, equal contexts
  as one with their number.
* A shard builds its suffix array with common prefixes by external induced
  sorting (``induced_sort``); windows are equal where neighbours in it share
  ``length`` bytes.

An anchor with too many different contexts for one task is split: its windows are
halved by their distance from the anchor, and each half is dealt anew by the
bytes that all windows of that half have in common. At the last halving equal
windows are equal contexts, so even a passage that a third of all documents
share, each with its own surroundings, meets in bounded groups.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import stored
from ordermart.llm.induced_sort import repeated_starts

LENGTH = 400
#: Bytes of contexts that a shard is planned for, and that one key may bring into it.
SHARD_BYTES, KEY_BYTES = 1 << 21, 1 << 21
#: Starts that are looked at together; bounds the memory of very long texts.
_STARTS = 1 << 21
#: Bytes of contexts, and contexts, that a task holds before it passes them on.
_PASSED_BYTES, _PASSED_ROWS = 1 << 22, 1 << 14
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_CONTEXT = ["key", "low", "high", "anchor", "id", "n", "bytes"]


# ---- anchors ---------------------------------------------------------------

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2^64."""
    factors = np.ones((2, n), np.uint64)
    factors[0, 1:], factors[1, 1:] = _MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)
    up, down = np.cumprod(factors, axis=1, dtype=np.uint64)
    return up, down


class Anchors:
    """Finds the stretches of starts that share an anchor."""

    def __init__(self, length: int):
        self.length, self.gram = length, max(1, length * 16 // 100)
        self.window = length - self.gram + 1
        self.table = np.random.default_rng(3).integers(1, 1 << 63, 256, np.uint64)
        self.up, self.down = _powers(1 << 12)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.up):
            self.up, self.down = _powers(1 << int(n).bit_length())
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.table[data] * self.up[:n], dtype=np.uint64)))
        x = (sums[self.gram:] - sums[:-self.gram]) * self.down[:n - self.gram + 1]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def stretches(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(hash, position of the anchor, first start, last start) in the order of the text."""
        data, out = np.frombuffer(text, np.uint8), []
        for lo in range(0, len(data) - self.length + 1, _STARTS):
            part = data[lo:lo + _STARTS + self.length - 1]
            hashes, w = self._hashes(part), self.window
            keys = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)  # ties: the first
            starts = len(part) - self.length + 1
            blocks = -(-len(keys) // w)
            padded = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
            padded[:len(keys)] = keys
            padded = padded.reshape(blocks, w)
            ahead = np.minimum.accumulate(padded, axis=1).ravel()
            behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
            anchor = (np.minimum(behind[:starts], ahead[w - 1:w - 1 + starts]) & np.uint64(0xFFFFFF)).astype(np.int64)
            first = np.nonzero(np.diff(anchor, prepend=-1))[0]
            last = np.append(first[1:], starts) - 1
            out += zip(hashes[anchor[first]].view(np.int64).tolist(), (anchor[first] + lo).tolist(),
                       (first + lo).tolist(), (last + lo).tolist())
        return out


def _id(context: bytes) -> bytes:
    return hashlib.blake2b(context, digest_size=16).digest()


def _bytes(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


# ---- shards ----------------------------------------------------------------

def _halves(row, length: int) -> Iterator[tuple]:
    """A context cut into the windows of either half of their distances from the anchor."""
    middle = (row.low + row.high) // 2
    for low, high in ((row.low, middle), (middle, row.high)):
        first, last = max(0, row.anchor - high + 1), min(len(row.bytes) - length, row.anchor - low)
        if low < high and first <= last:
            common = row.bytes[row.anchor - low:row.anchor - high + 1 + length]
            key = xxhash.xxh64_intdigest(common, (int(row.key) ^ (int(low) << 32) ^ int(high)) & 0xFFFFFFFFFFFFFFFF)
            part = row.bytes[first:last + length]
            yield (int(np.uint64(key).astype(np.int64)), low, high, row.anchor - first, _id(part), row.n, part, row.id, first)


def _merged(contexts: DataFrame) -> DataFrame:
    """Equal contexts as one; what depends on the bytes alone is the same in all of them."""
    return contexts.groupBy("key", "low", "high", "id").agg(
        F.first("anchor").alias("anchor"), F.sum("n").alias("n"), F.first("bytes").alias("bytes")
    ).select(*_CONTEXT)


def _split(contexts: DataFrame, length: int) -> DataFrame:
    def halve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [half for row in batch.itertuples(index=False) for half in _halves(row, length)]
            yield pd.DataFrame(out, columns=[*_CONTEXT, "parent", "shift"])

    return contexts.mapInPandas(
        halve, "key long, low int, high int, anchor int, id binary, n long, bytes binary, parent binary, shift int"
    )


def _repeats(contexts: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(id, starts, stops): the repeated starts of every context that has some, as inclusive ranges."""

    def sort(shard: pd.DataFrame) -> pd.DataFrame:
        parts, out = shard["bytes"].tolist(), []
        for id_, n, part, starts in zip(shard["id"], shard["n"], parts, repeated_starts(parts, length)):
            if n > 1:  # the context itself stands in several places
                out.append((id_, [0], [len(part) - length]))
            elif len(starts):
                cuts = np.nonzero(np.diff(starts) > 1)[0]
                out.append((id_, starts[np.append(0, cuts + 1)].tolist(), starts[np.append(cuts, len(starts) - 1)].tolist()))
        return pd.DataFrame(out, columns=["id", "starts", "stops"])

    size = contexts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("key"), F.lit(-(-size // shard_bytes) or 1)).alias("shard")
    return contexts.select(shard, "id", "n", "bytes").groupBy("shard").applyInPandas(
        sort, "id binary, starts array<int>, stops array<int>"
    )


# ---- the operator ----------------------------------------------------------

def repeated_passages(docs: DataFrame, *, length: int = LENGTH, key_bytes: int = KEY_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(row_key, starts, stops): inclusive ranges of the starts of repeated windows, for (row_key, text) rows."""

    def anchors_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = Anchors(length)
        for batch in batches:
            found = [Counter(s[0] for s in anchors.stretches(_bytes(t))) for t in batch["text"]]
            yield pd.DataFrame({
                "row_key": np.repeat(batch["row_key"].to_numpy(np.int64), [len(f) for f in found]),
                "key": np.fromiter((k for f in found for k in f), np.int64),
                "n": np.fromiter((n for f in found for n in f.values()), np.int64),
            })

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, names = Anchors(length), ["row_key", "key", "anchor", "id", "bytes", "firsts"]
        rows, size = [], 0
        for batch in batches:
            for row_key, keys, text in zip(batch["row_key"], batch["keys"], batch["text"]):
                wanted, data, contexts = set(keys), _bytes(text), {}
                for key, anchor, first, last in anchors.stretches(data):
                    if key in wanted:
                        part = data[first:last + length]
                        contexts.setdefault(part, (key, anchor - first, []))[2].append(first)
                rows += [(row_key, key, anchor, _id(part), part, firsts) for part, (key, anchor, firsts) in contexts.items()]
                size += sum(map(len, contexts))
                if size >= _PASSED_BYTES or len(rows) >= _PASSED_ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
        yield pd.DataFrame(rows, columns=names)

    long_ones = docs.where(F.octet_length("text") >= length)
    found = stored(long_ones.mapInPandas(anchors_of, "row_key long, key long, n long"), "anchors")
    shared = stored(found.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"), "shared_anchors")
    wanted = stored(found.join(shared, "key").groupBy("row_key").agg(F.collect_set("key").alias("keys")), "wanted")
    stretches = stored(
        long_ones.join(wanted, "row_key").select("row_key", "keys", "text")
        .mapInPandas(cut, "row_key long, key long, anchor int, id binary, bytes binary, firsts array<int>"),
        "stretches",
    )
    contexts = stored(
        _merged(stretches.select(
            "key", F.lit(0).alias("low"), F.lit(Anchors(length).window).alias("high"), "anchor", "id",
            F.size("firsts").cast("long").alias("n"), "bytes",
        )),
        "contexts",
    )
    ready, pieces = None, []
    while True:
        heavy = contexts.groupBy("key").agg(F.sum(F.length("bytes")).alias("size"), F.max(F.col("high") - F.col("low")).alias("span"))
        heavy = stored(heavy.where((F.col("size") > key_bytes) & (F.col("span") > 1)).select("key"), "heavy")
        light = contexts.join(heavy, "key", "left_anti")
        ready = light if ready is None else ready.unionByName(light)
        if heavy.isEmpty():
            break
        halves = stored(_split(contexts.join(heavy, "key", "left_semi").select(*_CONTEXT), length), "halves")
        pieces.append(halves.select("parent", "shift", "id").distinct())
        contexts = stored(_merged(halves), "contexts")
    known = stored(_repeats(ready, length, shard_bytes), "repeats")
    for level in reversed(pieces):
        up = level.join(known, "id").select(F.col("parent").alias("id"), *[
            F.transform(side, lambda s: s + F.col("shift")).alias(side) for side in ("starts", "stops")
        ])
        known = stored(known.unionByName(up).distinct(), "repeats")
    places = stretches.select("row_key", "id", "firsts").distinct().join(known, "id").select(
        "row_key", F.explode("firsts").alias("first"), "starts", "stops"
    )
    return places.groupBy("row_key").agg(*[
        F.flatten(F.collect_list(F.transform(side, lambda s: s + F.col("first")))).alias(side) for side in ("starts", "stops")
    ])


def remove_repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, starts, stops, kept.

    Removed is every byte of the UTF-8 text that is covered by a string of
    ``length`` bytes which also starts anywhere else, in the same document or in
    another; all such strings go, the first one too. ``starts`` and ``stops`` are
    the maximal removed runs (stop exclusive), ``kept`` the other bytes in their
    order, as binary since a cut may go through a character.

    Strings never cross documents and are judged on the input. Null text counts
    as empty; texts shorter than ``length`` stay whole; a row that is repeated
    counts as often as it stands there, so its text goes if it is long enough.
    Null identifiers stay null. An empty table gives an empty result; other
    columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(
        F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("row_key", F.xxhash64("id", "text"))
    found = stored(repeated_passages(keyed.select("row_key", "text"), length=length, **options), "passages")

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for id_, text, starts, stops in zip(batch["id"], batch["text"], batch["starts"], batch["stops"]):
                data, runs = _bytes(text), []
                for lo, hi in sorted(zip(starts, stops)) if starts is not None else ():
                    if runs and lo <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], int(hi) + length)
                    else:
                        runs.append([int(lo), int(hi) + length])
                edges = [0, *[x for run in runs for x in run], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((id_, len(data), len(data) - len(kept), [r[0] for r in runs], [r[1] for r in runs], kept))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "starts", "stops", "kept"])

    columns = "id string, n_bytes long, n_removed long, starts array<int>, stops array<int>, kept binary"
    return keyed.join(found, "row_key", "left").select("id", "text", "starts", "stops").mapInPandas(
        remove, columns
    ).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
