"""Vector codes against a plain search of all entries."""

import math
import random

import numpy as np
import pytest

from ordermart.llm.vector_codes import Codebook, codebooks_digest, vector_codes, with_label_error


def plain_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    """[(id, label, code, error)] and the codebooks, by measuring every entry."""
    kept = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for c in cut:
                members[nearest(c[p], book)[1]].append(c[p])
            books[p] = [[sum(x) // len(m) for x in zip(*m)] if m else e for e, m in zip(book, members)]
    out = []
    for (i, label, _), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, label, [k for _, k in best], sum(d for d, _ in best)))
    return out, books


@pytest.mark.parametrize("seed,high,entries,width", [(0, 3, 64, 2), (1, 100, 64, 4), (2, 1, 7, 3), (3, 30, 1, 1), (4, 2000, 200, 8)])
def test_the_search_finds_the_nearest_and_lowest_entry(seed, high, entries, width):
    rng = np.random.default_rng(seed)
    book, parts = rng.integers(-high, high + 1, (entries, width)), rng.integers(-2 * high, 2 * high + 1, (3000, width))
    chosen, distance = Codebook(book).nearest(parts)
    plain = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (chosen == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def vectors(n, dims, seed, whole=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.randrange(-2, 3) / 64 if whole else rng.gauss(0, 0.1) for _ in range(dims)]
        rows.append((rng.choice([i, i, None, 7]) if i % 5 == 0 else i, v, rng.choice([None, 0, 1, 2])))
    rows += [(1000, None, 0), (1001, [None] + [0.0] * (dims - 1), 1), (1002, [float("nan")] + [0.0] * (dims - 1), 1),
             (1003, [float("-inf")] + [0.0] * (dims - 1), None), rows[3], rows[3], (2**60 + 1, rows[1][1], None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,dims,whole", [(300, 32, False), (200, 16, True), (20, 48, False)])
def test_codes(spark, n, dims, whole):
    rows = vectors(n, dims, n, whole)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, whole string")
    found, book = vector_codes(frame.repartition(5))
    expected, books = plain_codes(rows)
    assert book.tolist() == books
    totals = {}
    for _, label, _, error in expected:
        totals[label] = totals.get(label, 0) + error
    out = [tuple(r) for r in with_label_error(found).collect()]
    assert sorted(out, key=repr) == sorted([(*r, totals[r[1]]) for r in expected], key=repr)
    assert len(codebooks_digest(book)) == 64


def test_other_lengths_and_empty_tables(spark):
    rows = [(0, [0.5] * 5, 1), (1, [0.5] * 32, 1), (2, [0.25] * 48, 1), (3, [], 2), (4, [1e30] * 32, 2), (5, [0.25] * 32, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found, book = vector_codes(frame)
    assert book.shape == (16, 2, 2)
    codes = {r["vec_id"]: (r["code"], r["error"]) for r in found.collect()}
    assert codes == {0: (None, None), 1: ([0] * 16, 0), 2: (None, None), 3: (None, None), 4: (None, None), 5: ([1] * 16, 0)}
    nothing, book = vector_codes(frame.limit(0))
    assert with_label_error(nothing).collect() == [] and book.size == 0
    only_odd, _ = vector_codes(frame.where("vec_id = 0"))
    assert [tuple(r) for r in only_odd.collect()] == [(0, 1, None, None)]
