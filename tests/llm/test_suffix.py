"""Suffix-array dedup against brute force, and its corner cases."""

import random

import pytest

from ordermart.llm import suffix_dedup
from ordermart.llm.suffix_dedup import Anchors, remove_repeated_passages


def brute(rows, length):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for i, d in enumerate(data):
        for s in range(len(d) - length + 1):
            seen.setdefault(d[s:s + length], []).append((i, s))
    gone = [set() for _ in rows]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i].update(range(s, s + length))
    out = []
    for (id_, _), d, g in zip(rows, data, gone):
        spans = sum(1 for b in g if b - 1 not in g)
        out.append((id_, len(d), len(g), spans, bytes(b for at, b in enumerate(d) if at not in g)))
    return sorted(out, key=repr)


def run(spark, rows, length, **options):
    frame = spark.createDataFrame([(i, t, i, b"x") for i, t in rows], "doc_id long, text string, key long, bytes binary")
    found = remove_repeated_passages(frame, length=length, **options).collect()
    return sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["starts"]), bytes(r["kept"])) for r in found], key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    letters = "abcdefgh é"
    text = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [text(rng.randint(30, 120)) for _ in range(6)]
    rows = []
    for i in range(n):
        body = text(rng.randint(0, 200))
        if rng.random() < 0.6:
            at = rng.randint(0, len(body))
            passage = rng.choice(shared)
            lo = rng.randrange(len(passage) // 2)
            body = body[:at] + passage[lo:lo + rng.randint(20, 120)] + body[at:]
        rows.append((i, body))
    return rows + [(900, rows[0][1]), (901, rows[0][1]), (902, "a" * 150), (903, "ab" * 70), (904, None), (905, "")]


@pytest.mark.parametrize("options", [{}, {"key_bytes": 150, "shard_bytes": 2000}])
def test_equals_brute_force(spark, options):
    rows = corpus(1)
    assert run(spark, rows, 25, **options) == brute(rows, 25)


def test_common_passage_with_own_surroundings_is_split(spark):
    rng = random.Random(9)
    text = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    passage = text(60)
    rows = [(i, text(80) + passage + text(80)) for i in range(80)]
    assert run(spark, rows, 40, key_bytes=300, shard_bytes=3000) == brute(rows, 40)


def test_repeated_rows_missing_ids_and_empty_table(spark):
    rows = [(1, "x" * 30 + "one"), (1, "x" * 30 + "one"), (None, "some text of its own here"), (None, None)]
    assert run(spark, rows, 20) == brute(rows, 20)
    assert run(spark, [], 20) == []


def test_stretches_cover_every_start_once():
    rng = random.Random(2)
    anchors = Anchors(50)
    for n in (49, 50, 51, 400, 3000):
        data = bytes(rng.choice(b"abc") for _ in range(n))
        starts = [p for _, _, first, last in anchors.stretches(data) for p in range(first, last + 1)]
        assert starts == list(range(n - 49))


@pytest.mark.parametrize("most_bytes,most_rows", [(200, 1 << 14), (1 << 22, 3), (1 << 22, 1 << 14)])
def test_contexts_are_passed_on_for_many_documents_at_once(spark, monkeypatch, most_bytes, most_rows):
    monkeypatch.setattr(suffix_dedup, "_PASSED_BYTES", most_bytes)
    monkeypatch.setattr(suffix_dedup, "_PASSED_ROWS", most_rows)
    rows = corpus(31)
    assert run(spark, rows, 40) == brute(rows, 40)
