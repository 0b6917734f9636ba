"""Periodic runs against a plain search of every period."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermart.llm import queries
from ordermart.llm.periodic_runs import collapsed, periodic_runs, runs_of_texts


def plain_runs(words, min_length=12):
    """Every maximal stretch of each period, with the least period of a stretch."""
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i < n - p and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(min_length, 2 * p):
                best.setdefault((start, i + p), p)
    return sorted(((s, e - s, p) for (s, e), p in best.items()), key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=60), max_size=4), st.sampled_from([2, 5, 12]))
def test_runs_of_short_alphabets(texts, min_length):
    texts = [list(t) for t in texts]
    found = runs_of_texts(texts, min_length)
    assert found == [plain_runs(t, min_length) for t in texts]
    assert [collapsed(t, r) for t, r in zip(texts, found)] == [plain_kept(t, r) for t, r in zip(texts, found)]


@pytest.mark.parametrize("seed", range(8))
def test_runs_among_other_words(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = []
        for _ in range(rng.randrange(6)):
            words += [f"w{rng.randrange(50)}" for _ in range(rng.randrange(30))]
            unit = [f"w{rng.randrange(6)}" for _ in range(rng.randrange(1, 12))]
            words += (unit * 40)[:rng.randrange(1, 90)]
        texts.append(words)
    texts += [texts[0], ["a"] * 700, ["a", "b"] * 300 + ["a"] * 40 + ["a", "b"] * 50, []]
    assert runs_of_texts(texts) == [plain_runs(t) for t in texts]


def test_a_phrase_with_many_neighbours_is_not_compared_pair_by_pair():
    words = []
    for i in range(20_000):
        words += [f"l{i}", *"abcdefgh", f"r{i}"]
    assert runs_of_texts([words]) == [[]]
    assert runs_of_texts([["x"] * 200_000]) == [[(0, 200_000, 1)]]


def test_rows(spark):
    long = " ".join(f"w{i % 7}" for i in range(50_000))
    rows = [(1, None, 5, "x"), (2, "", 5, "x"), (3, "a " * 11, 5, "x"), (4, "a\t" * 12, 5, "x"), (4, "a\t" * 12, 5, "x"),
            (None, "a " * 13, 5, "x"), (5, long, 5, "x"), (6, "  é   é " * 6, 5, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id int, runs string")
    found = sorted(map(tuple, periodic_runs(frame).collect()), key=repr)
    expected = []
    for i, text, *_ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = plain_runs(words) if len(words) < 1000 else [(0, 50_000, 7)]
        expected.append((i, len(words), runs, " ".join(plain_kept(words, runs))))
    assert [(a, b, [tuple(r) for r in c], d) for a, b, c, d in found] == sorted(expected, key=repr)
    assert periodic_runs(frame.limit(0)).collect() == []


def test_the_query(spark, tmp_path):
    """Repetition is put into every tenth text as the contract says; the digests are recounted."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(80)))) for i in range(150)]
    rows += [(200 + i, None) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    changed = 0
    for i, text in rows:
        words, h = (text or "").split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        r = found[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(plain_kept(words, runs)).encode()).hexdigest()
    assert changed > 5
