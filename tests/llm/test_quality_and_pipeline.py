"""The quality classifier by held-out accuracy, and the pipeline stage by stage."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from ordermart.llm.common import stored
from ordermart.llm.quality_classifier import FEATURES, TextFeatures, keep_good, logistic, quality_scores
from ordermart.llm.simhash_dedup import fingerprint

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=400):
    """Good documents of plain words; bad ones shout or hold words of one kind; the source tells a little."""
    rng = random.Random(3)
    plain, rude = [f"word{i}" for i in range(300)], ["rubbish", "nonsense", "trash"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        kind = rng.choice(["good", "good", "loud", "rude"])
        if kind == "loud":
            words = [w.upper() + "!!" for w in words]
        if kind == "rude":
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(rude))
        text = " ".join(words)
        docs.append((i, text, "en", f"s{i % 3}" if kind == "good" else "spam" if rng.random() < 0.3 else "s1", len(text)))
        labels.append((i, int(kind != "loud"), int(kind == "rude"), kind))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    odd = [(5000, None, None, None, None), (5001, "", "en", "s1", 0), (None, docs[0][1], "en", "s1", 5), docs[3]]
    frame = spark.createDataFrame([(*d, 1.5, 9, "x") for d in docs + odd], SHAPE + ", score double, y long, features string")
    known = spark.createDataFrame([r[:3] for r in labels if r[0] % 2], "doc_id long, quality int, toxic int")
    known = known.unionByName(spark.createDataFrame([(None, 1, 0), (7, None, None)], known.schema))
    out = quality_scores(frame, known).collect()
    assert len(out) == len(docs) + len(odd) and all(0 <= r["score"] <= 1 for r in out)
    accepted = {r["doc_id"]: r["accepted"] for r in out}
    held = [(accepted[i], kind == "good") for i, _, _, kind in labels if i % 2 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.93
    good = [a for a, b in held if b]
    assert sum(good) / len(good) > 0.95
    kept = keep_good(frame, known)
    assert kept.columns == frame.columns and kept.count() == sum(r["accepted"] for r in out)


def test_rare_bad_labels_are_learned_from(spark):
    docs, labels = corpus()
    loud = [r[0] for r in labels if r[3] == "loud"]
    known = [r[:3] for r in labels if r[3] == "good"] + [(i, 0, 0) for i in loud[:8]]
    frame, shape = spark.createDataFrame(docs, SHAPE), "doc_id long, quality int, toxic int"
    scores = {r["doc_id"]: r["score"] for r in quality_scores(frame, spark.createDataFrame(known, shape), max_labelled=40).collect()}
    fine = [scores[r[0]] for r in labels if r[3] == "good"]
    held = [scores[i] for i in loud[8:]]
    assert len(set(scores.values())) > 1 and sum(x < 0.5 for x in held) / len(held) > 0.8
    assert sum(x >= 0.5 for x in fine) / len(fine) > 0.95


def test_nothing_to_learn_from(spark):
    docs, _ = corpus(20)
    frame = spark.createDataFrame(docs, SHAPE)
    shape = "doc_id long, quality int, toxic int"
    assert {r["score"] for r in quality_scores(frame, spark.createDataFrame([], shape)).collect()} == {1.0}
    assert {r["score"] for r in quality_scores(frame, spark.createDataFrame([(1, 0, 0), (2, 0, 1)], shape)).collect()} == {0.0}
    assert quality_scores(frame.limit(0), spark.createDataFrame([(1, 1, 0)], shape)).collect() == []


def test_logistic():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 2))
    y = (draw.random(4000) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.5 * x[:, 1] + 0.25)))).astype(float)
    np.testing.assert_allclose(logistic(x, y), [1.5, -0.5, 0.25], atol=0.15)


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage has read and returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SF), name)
        out[name], docs = (docs, result), result
    return out


def test_columns_and_order(stages):
    assert list(stages) == ["quality", "lines", "near_copies", "benchmark_leaks", "mix"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, (before, after) in stages.items():
        assert before.columns == columns and (name == "mix" or after.columns == columns)


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    rows = before.join(labels, "doc_id").collect()
    good = [r["doc_id"] in kept for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["doc_id"] in kept for r in rows if r["quality"] == 0 or r["toxic"] == 1]
    assert sum(good) / len(good) > 0.9 and sum(bad) / max(1, len(bad)) < 0.4


def test_lines_stage_leaves_no_equal_lines(stages):
    before, after = stages["lines"]
    assert sorted(r[0] for r in before.select("doc_id").collect()) == sorted(r[0] for r in after.select("doc_id").collect())
    normal = [" ".join(x.lower().split()) for r in after.collect() for x in (r["text"] or "").split("\n")]
    normal = [x for x in normal if x]
    assert len(normal) == len(set(normal))


def test_near_copies_stage_keeps_one_of_each_group(stages):
    before, after = stages["near_copies"]
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in before.collect()}
    parent = {p: p for p in prints.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = sorted(parent)
    for n, x in enumerate(values):
        for y in values[:n]:
            if bin(x ^ y).count("1") <= 2:
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
    first = {}
    for i in sorted(prints):
        first.setdefault(root(prints[i]), i)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(first.values())


def test_leaks_stage(spark, stages):
    before, after = stages["benchmark_leaks"]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = before.collect()
    verbatim = {r["doc_id"] for r in rows if any(x in (r["text"] or "") for x in items)}
    kept = {r["doc_id"] for r in after.collect()}
    assert not kept & verbatim and len(kept) >= len(rows) - len(verbatim) - max(2, len(rows) // 50)


def test_mix_stage_reads_every_document(stages):
    before, after = stages["mix"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}
    assert after.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 5


def test_run_gives_the_schedule(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["mix"][1].count()


def test_features_of_plain_tokens_are_those_of_all():
    known = TextFeatures()
    for token in ["Word", "WORD!!", "a", "A", "word###", "x,y", "3a.", "İs", "ß", "don't", "--", "w1|", "Æon,", "wörter"]:
        letters = re.findall(r"[^\W\d_]+", token.lower())
        shape = re.sub(r"[^\W\d_]+", lambda m: "A" if len(m.group()) > 1 and m.group().isupper() else "a", token)
        shape = re.sub(r"\d+", "0", shape)
        names = {f"word {w}" for w in letters} | {f"shape {shape}"}
        expected = sorted({zlib.crc32(n.encode()) % FEATURES for n in names})
        assert known.of(f"{token} {token}").tolist() == expected and sorted(known[token]) == expected, token
    assert len(known.of(None)) == 0 and known.of("b a b").tolist() == sorted({*known["a"], *known["b"]})
