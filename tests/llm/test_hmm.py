"""Hidden Markov scoring against plain recursions, and its corner cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.llm.hmm_scoring import (
    Hmm, Sequences, baum_welch_step, class_of, estimate, first_guess, pack_blocks, score_documents,
)


def plain_expected(hmm, docs):
    k, (starts, moves, emits, logs) = len(hmm.start), (0, 0, 0, [])
    starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros_like(hmm.emit)
    for doc in docs:
        alpha = [hmm.start * hmm.emit[:, doc[0]]]
        for x in doc[1:]:
            alpha.append((alpha[-1] @ hmm.move) * hmm.emit[:, x])
        beta = [np.ones(k)]
        for x in reversed(doc[1:]):
            beta.insert(0, hmm.move @ (hmm.emit[:, x] * beta[0]))
        p = alpha[-1].sum()
        logs.append(math.log(p))
        starts += alpha[0] * beta[0] / p
        for t, x in enumerate(doc):
            emits[:, x] += alpha[t] * beta[t] / p
            if t:
                moves += alpha[t - 1][:, None] * hmm.move * (hmm.emit[:, x] * beta[t])[None, :] / p
    return starts, moves, emits, np.array(logs)


@pytest.mark.parametrize("segment", [1, 3, 5, 64])
def test_recursions_equal_the_plain_ones(segment):
    rng = random.Random(segment)
    docs = [[rng.randrange(6) for _ in range(rng.choice([1, 2, 3, 7, 15, 30]))] for _ in range(25)]
    hmm = first_guess(np.array([4, 2, 1, 1, 1, 3]) / 12, 3)
    s = Sequences(np.array([x for d in docs for x in d]), np.array([len(d) for d in docs]), segment)
    starts, moves, emits, logs = plain_expected(hmm, docs)
    found = hmm.expected(s)
    for a, b in zip(found, (starts, moves, emits)):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(hmm.log_likelihood(s), logs, rtol=1e-10)


def test_training_never_lowers_the_likelihood():
    rng = random.Random(4)
    docs = [[(rng.randrange(3) if i % 2 else 3 + rng.randrange(3)) for _ in range(40)] for i in range(30)]
    s = Sequences(np.array([x for d in docs for x in d]), np.array([40] * 30), 16)
    hmm, last = first_guess(np.full(6, 1 / 6), 2), -math.inf
    for _ in range(8):
        now = hmm.log_likelihood(s).sum()
        assert now > last - 1e-6 * abs(now)
        last, hmm = now, estimate(*hmm.expected(s))
    assert last > 30 * 40 * math.log(1 / 6) * 0.75  # two kinds of text are told apart


def test_no_sequences():
    s = Sequences(np.zeros(0, np.int64), np.zeros(0, np.int64))
    hmm = Hmm(np.ones(1), np.ones((1, 1)), np.ones((1, 2)) / 2)
    assert len(hmm.log_likelihood(s)) == 0 and hmm.expected(s)[0].sum() == 0


def corpus(n=120):
    rng = random.Random(8)
    one, two = [f"ab{i}" for i in range(40)], [f"xy{i}" for i in range(40)]
    rows = []
    for i in range(n):
        words = one if i % 2 else two
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 700)))))
    return rows + [(500, None), (501, ""), (502, " \t\n "), (503, "UNSEEN ab1 Éa"), (None, "ab1 ab2"), (3, rows[3][1])]


def test_operator(spark):
    rows = corpus()
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    frame = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, words string").repartition(3)
    out = score_documents(frame, held, block_chars=5000)
    assert out.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = out.collect()
    assert len(found) == len(rows)

    def tokens(t):
        return (t or "").replace("U", "u").replace("N", "n").replace("S", "s").replace("E", "e").split() + [" "]

    def is_held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    counts = Counter(w for i, t in rows if not is_held(i) for w in tokens(t.replace("D", "d") if t else t))
    n, v = sum(counts.values()), len(counts)
    texts = {(-1 if i is None else i): t for i, t in rows}
    for r in found:
        i = -1 if r["doc_id"] is None else r["doc_id"]
        words = tokens(texts[i].replace("D", "d") if texts[i] else texts[i])
        assert r["held_out"] == is_held(r["doc_id"]) and r["train_tokens"] == n
        assert r["n_tokens"] == len(words) and r["n_known"] == sum(w in counts for w in words)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held_rows = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held_rows) > sum(r["base_score"] for r in held_rows)


def test_probabilities_of_one_word_texts_sum_to_one(spark):
    """Over all known words, one unseen word per class and the closing mark."""
    rows = [(i, t) for i, t in enumerate(["a b", "a c", "b b d", "c"])]
    known = ["a", "b", "c", "d"]
    unseen, taken, n = [], set(), 0
    while len(taken) < 8:
        word = f"u{n}"
        n += 1
        if class_of(word, 8) not in taken:
            taken.add(class_of(word, 8))
            unseen.append(word)
    probes = known + unseen
    frame = spark.createDataFrame(rows + [(100 + i, w) for i, w in enumerate(probes)] + [(99, "")], "doc_id long, text string")
    out = {r["doc_id"]: r["score"] for r in score_documents(frame, F.col("doc_id") >= 99, classes=8, states=2).collect()}
    # A text of one word has two tokens; its probability is at most that of its first token, so the sum stays below one.
    assert 10 ** out[99] + sum(10 ** out[100 + i] for i in range(len(probes))) < 1.0


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert score_documents(frame, F.col("doc_id") == 1).collect() == []


def test_training_asks_for_classes_and_not_for_words(spark):
    docs = spark.createDataFrame([("1", False, "a B c a"), ("2", True, "d"), ("3", False, None)], "id string, held_out boolean, text string")
    blocks = pack_blocks(docs.coalesce(1), 1 << 20, 8)
    row = blocks.first()
    assert np.frombuffer(row["classes"], np.uint32).tolist() == [class_of(w, 8) for w in row["words"]]
    model = first_guess(np.full(9, 1 / 9), 2)
    learned = baum_welch_step(blocks.drop("words"), model, 8)
    assert learned.emit.shape == (2, 9) and learned.emit.sum() == pytest.approx(2)


def test_texts_without_words_are_scored(spark):
    frame = spark.createDataFrame([(1, ""), (2, None), (3, " ")], "doc_id long, text string").coalesce(1)
    out = score_documents(frame, F.col("doc_id") == 3).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in out] == [(1, 1, 2)] * 3
