"""SimHash near-dedup against all pairs, and its corner cases."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ordermart.llm.components import connected_components
from ordermart.llm.simhash_dedup import build_tree, fingerprint, route, simhash_dedup, spanning_links


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, radius):
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in points:
        for y in points:
            if bin(x ^ y).count("1") <= radius:
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    return {p: root(p) for p in points}


def clustered(n, seed):
    rng = random.Random(seed)
    points = set()
    while len(points) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            points.add(x)
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                x ^= 1 << rng.randrange(64)
    return sorted(points)


def test_fingerprint_matches_definition():
    for text in [None, "", " \t\n", "One", "One two", "a b c", "É A\x0bb ÉÉ c d e f g " * 9, "x " * 1000]:
        assert fingerprint(text) == plain_fingerprint(text)


def test_tree_and_shards_find_the_components_of_all_pairs():
    points = clustered(1500, 3)
    array = np.array(points, np.uint64)
    expected = groups(points, 2)
    tree = build_tree(array[::3], 16, 2)
    index, shard = route(array, tree, 2)
    assert set(index.tolist()) == set(range(len(points)))
    links = [link for s in set(shard.tolist()) for link in spanning_links(array[index[shard == s]], 2)]
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert bin(a ^ b).count("1") <= 2
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert {p: root(p) for p in points} == expected


def test_points_that_nothing_separates():
    array = np.array([1 << i for i in range(64)] * 5, np.uint64)
    links = spanning_links(np.unique(array), 2)
    assert len(links) == 63


def test_operator_equals_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 300))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy).upper())
    texts += ["", None, "  ", "one", "ONE"]
    rows = [(i * 3, t, "clash") for i, t in enumerate(texts)] + [(None, "one", "x"), (0, texts[0], "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash_dedup(frame).collect()
    assert len(found) == len(rows)
    label = groups({plain_fingerprint(t) for _, t, _ in rows}, 2)
    least = {}
    for i, t, _ in rows:
        if i is not None:
            c = label[plain_fingerprint(t)]
            least[c] = min(i, least.get(c, i))
    expected = sorted((i if i is not None else -1, f"{plain_fingerprint(t):016x}", least[label[plain_fingerprint(t)]]) for i, t, _ in rows)
    assert sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in found) == expected


def test_spark_hash_is_the_same_and_empty_table(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("to be or"))).first()[0]
    assert value % (1 << 64) == xxhash.xxh64_intdigest(b"to be or", 42)
    assert simhash_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 300)] + [(5, 5), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = dict(tuple(r) for r in connected_components(frame).collect())
    assert found == {i: 100 for i in range(100, 161)} | {7: 7} | {k: 7 for k in range(200, 300)}
