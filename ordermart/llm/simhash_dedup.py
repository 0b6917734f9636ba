"""SimHash near-dedup: fingerprints partitioned by a vantage-point tree.

A node of the tree holds a vantage point and a radius m: fingerprints at a
Hamming distance d <= m from the point go to its left. Two fingerprints within r
bits of each other differ by at most r in d (triangle inequality), so a
fingerprint on the left with d <= m - r has no partner on the right and that
branch is pruned; one with m - r < d <= m overlaps the boundary and is sent to
the right as well. By induction every pair within r bits shares a leaf. The
upper tree is fitted on a bounded sample and deals all fingerprints to shards;
each shard goes on with a tree of its own and compares pairs in small leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import LOWER, UPPER, stored
from ordermart.llm.components import connected_components

#: Fingerprints that one shard is planned for.
SHARD_ROWS = 50_000
#: Fingerprints of the sample for each shard, and at most; the upper tree is fitted on them.
SAMPLE_PER_SHARD, MAX_SAMPLE = 64, 1 << 20
_LEAF, _STEP = 192, 1 << 16
_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


# ---- fingerprints ----------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles; a bit is set if over half of the hashes set it."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_ASCII_LOWER).split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    stops = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, stops)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _STEP):
        rows = hashes[at:at + _STEP].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _signed(values) -> np.ndarray:
    return np.fromiter(values, np.uint64).view(np.int64)


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) of every row; fp holds the 64 bits as a long."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "fp": _signed(fingerprint(t, shingle) for t in batch["text"])})

    whole = source.select(F.col("id").cast("string"), "text")
    return whole.mapInPandas(compute, "id string, fp long").select(F.col("id").cast(kind).alias("id"), "fp")


# ---- vantage-point tree ----------------------------------------------------

def _distances(points: np.ndarray, to) -> np.ndarray:
    return np.bitwise_count(points ^ to)


def _split(points: np.ndarray, radius: int, draw: np.random.Generator) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that send the fewest points both ways; None if nothing separates them."""
    best, least = None, len(points) * 2
    seen = points if len(points) <= 4096 else points[draw.integers(0, len(points), 4096)]
    for candidate in seen[draw.integers(0, len(seen), 6)]:
        d = _distances(seen, candidate).astype(np.int64)
        for m in {int(np.median(d)), int(np.median(d)) - 1}:
            left, right = int((d <= m).sum()), int((d > m - radius).sum())
            cost = max(left, right) * len(points) // len(seen)
            if cost < least and max(left, right) < len(seen):
                best, least = (candidate, m), cost
    return best


def build_tree(sample: np.ndarray, shards: int, radius: int, seed: int = 11) -> list[tuple]:
    """Upper tree as a list of nodes (vantage point, m, left, right); a leaf is (shard,)."""
    draw, nodes, number = np.random.default_rng(seed), [], 0
    todo = [(sample, max(1, shards), None, 0)]
    while todo:
        points, wanted, parent, side = todo.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent][2 + side] = at
        cut = _split(points, radius, draw) if wanted > 1 and len(points) >= 8 else None
        if cut is None:
            nodes.append([number])
            number += 1
            continue
        d = _distances(points, cut[0]).astype(np.int64)
        nodes.append([cut[0], cut[1], 0, 0])
        todo.append((points[d > cut[1] - radius], wanted - wanted // 2, at, 1))
        todo.append((points[d <= cut[1]], wanted // 2, at, 0))
    return nodes


def route(points: np.ndarray, nodes: list[tuple], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the point, shard) for every shard a point belongs to or overlaps."""
    index, shard, todo = [], [], [(np.arange(len(points)), 0)]
    while todo:
        rows, at = todo.pop()
        node = nodes[at]
        if not len(rows):
            continue
        if len(node) == 1:
            index.append(rows)
            shard.append(np.full(len(rows), node[0], np.int64))
            continue
        d = _distances(points[rows], node[0]).astype(np.int64)
        todo += [(rows[d <= node[1]], node[2]), (rows[d > node[1] - radius], node[3])]
    if not index:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(index), np.concatenate(shard)


def spanning_links(points: np.ndarray, radius: int, seed: int = 13) -> list[tuple[int, int]]:
    """Links that connect the same points as all pairs within ``radius`` bits do."""
    draw, parent, links = np.random.default_rng(seed), {}, []

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    def join(xs: list[int], ys: list[int]) -> None:
        for x, y in zip(xs, ys):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                links.append((x, y))

    todo = [points]
    while todo:
        part = todo.pop()
        cut = _split(part, radius, draw) if len(part) > _LEAF else None
        if cut is not None:
            d = _distances(part, cut[0]).astype(np.int64)
            todo += [part[d <= cut[1]], part[d > cut[1] - radius]]
            continue
        for at in range(0, len(part), 256):
            rows, rest = part[at:at + 256], part[at:]
            x, y = np.nonzero(_distances(rows[:, None], rest[None, :]) <= radius)
            keep = y > x
            join(rows[x[keep]].tolist(), rest[y[keep]].tolist())
    return links


# ---- the operator ----------------------------------------------------------

def simhash_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z and cut at ASCII white space; shingles are
    ``shingle`` words long, a shorter text is one shingle, and a text without
    words (null, empty, blank) has fingerprint zero and is linked like any other.
    Fingerprints within ``max_bits`` bits are linked; ``component_id`` is the
    smallest identifier that can be reached. Rows without an identifier are
    linked but never name a component, unless it has no identifier at all (then
    null). Repeated rows are returned each; an empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    prints = stored(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct")
    number = distinct.count()
    shards = min(MAX_SAMPLE // SAMPLE_PER_SHARD, max(1, min(24, number // 256), -(-number // SHARD_ROWS)))
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(min(MAX_SAMPLE, shards * SAMPLE_PER_SHARD)).select("fp")
    tree = build_tree(sample.toPandas()["fp"].to_numpy(np.int64).view(np.uint64), shards, max_bits)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fp"].to_numpy(np.int64).view(np.uint64)
            index, shard = route(points, tree, max_bits)
            yield pd.DataFrame({"shard": shard, "fp": points[index].view(np.int64)})

    def link(shard: pd.DataFrame) -> pd.DataFrame:
        found = spanning_links(np.unique(shard["fp"].to_numpy(np.int64).view(np.uint64)), max_bits)
        return pd.DataFrame({"a": _signed(x for x, _ in found), "b": _signed(y for _, y in found)})

    links = (
        distinct.select("fp").mapInPandas(deal, "shard long, fp long")
        .groupBy("shard").applyInPandas(link, "a long, b long")
    )
    components = stored(connected_components(stored(links, "links")), "components")
    names = (
        components.join(distinct, components["node"] == distinct["fp"]).groupBy("component")
        .agg(F.min("least_id").alias("component_id"))
    )
    linked = components.join(names, "component").select(F.col("node").alias("fp"), "component_id")
    classes = stored(
        distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least_id").alias("component_id")),
        "classes",
    )
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
