"""Induced sorting against plain sorting of suffixes."""

import random

import numpy as np
import pytest

from ordermart.llm.induced_sort import SuffixSorter, repeated_starts


def plain(parts, length):
    seen = {}
    for i, p in enumerate(parts):
        for s in range(len(p) - length + 1):
            seen.setdefault(p[s:s + length], []).append((i, s))
    out = [[] for _ in parts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                out[i].append(s)
    return [sorted(x) for x in out]


def texts(seed):
    rng = random.Random(seed)
    letters = rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
    base = bytes(rng.choice(letters) for _ in range(rng.randint(5, 120)))
    parts = []
    for _ in range(rng.randint(1, 12)):
        lo = rng.randrange(len(base))
        parts.append(bytes(rng.choice(letters) for _ in range(rng.randint(0, 9))) + base[lo:lo + rng.randint(1, 90)]
                     + bytes(rng.choice(letters) for _ in range(rng.randint(0, 9))))
    return [p for p in parts if p] or [b"a"]


@pytest.mark.parametrize("budget", [1 << 25, 3])
def test_repeated_starts_equal_brute_force(budget):
    for seed in range(60):
        parts = texts(seed)
        for length in (1, 2, 5, 17):
            found = [x.tolist() for x in repeated_starts(parts, length, budget)]
            assert found == plain(parts, length), (seed, length)


def test_order_and_shared_prefixes():
    for seed in range(60):
        rng = random.Random(seed)
        body = [rng.randint(2, 5) for _ in range(rng.randint(1, 200))] + [1, 0]
        text, limit = np.array(body, np.uint16), rng.choice([3, 10, 300])
        suffixes = np.concatenate([s for s, _ in SuffixSorter(text, limit).descending()])
        shared = np.concatenate([x for _, x in SuffixSorter(text, limit).descending()])
        assert sorted(suffixes.tolist()) == list(range(len(body) - 1))
        cut = [body[s:s + limit] for s in suffixes]
        assert cut == sorted(cut, reverse=True)
        for k in range(1, len(cut)):
            same = 0
            while same < min(len(cut[k]), len(cut[k - 1])) and cut[k][same] == cut[k - 1][same]:
                same += 1
            assert shared[k] == min(same, limit)
