"""Exact dedup, mixing, revisits, decontamination and language identification on small tables."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ordermart.llm.common import passing_tables, stored
from ordermart.llm.decontamination import Template, consistent_share, contaminated, decontaminate
from ordermart.llm.exact_dedup import exact_dedup
from ordermart.llm import language_id
from ordermart.llm.language_id import count, held_out_language_id, identify, identify_whole, train
from ordermart.llm.source_mixing import mix_sources, mixing_exponent
from ordermart.llm.warc_revisits import canonical_url, resolve_revisits


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ---- exact dedup -----------------------------------------------------------

@pytest.mark.parametrize("keep,runs,fan_in", [("largest", 7, 2), ("smallest", 1, 8), ("largest", 64, 4)])
def test_exact_dedup(spark, keep, runs, fan_in):
    rows = [(i, ["One two", "ONE TWO", "É x", "é x", "", None, "z" * 5000][i % 7], 1, "c") for i in range(60)]
    rows += [(3, "ONE TWO", 2, "d"), (3, "ONE TWO", 2, "d"), (None, "alone", 1, "c"), (None, "One two", 1, "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, run int, digest string")
    found = exact_dedup(frame, keep=keep, runs=runs, fan_in=fan_in).collect()
    groups = defaultdict(list)
    for i, t, _, _ in rows:
        groups[lower(t)].append(i)
    best = max if keep == "largest" else min
    expected = []
    for i, t, _, _ in rows:
        group = groups[lower(t)]
        stays = best((x for x in group if x is not None), default=None)
        expected.append((i, stays, len(group), i == stays, hashlib.sha256(lower(t).encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_exact_dedup_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup(frame).collect() == []
    with pytest.raises(ValueError):
        exact_dedup(frame, keep="any")


# ---- mixing ----------------------------------------------------------------

def entropy(tokens, a):
    powers = [(t / sum(tokens)) ** a for t in tokens]
    return -sum(p / sum(powers) * math.log(p / sum(powers)) for p in powers)


@pytest.mark.parametrize("tokens,target,epochs", [
    ([900, 50, 30, 20], 0.9, 100.0), ([900, 50, 30, 20], 0.99, 3.0), ([100, 100, 100], 0.95, 4.0), ([10**9, 1], 0.5, 4.0),
])
def test_exponent_meets_the_limits_and_no_more(spark, tokens, target, epochs):
    frame = spark.createDataFrame([(t,) for t in [*tokens, 0]], "tokens long")
    a = mixing_exponent(frame, target_entropy=target, max_epochs=epochs)

    def allowed(a):
        most = (max(tokens) / min(tokens)) ** (1 - a)
        return entropy(tokens, a) <= target * math.log(len(tokens)) and most <= epochs

    assert 0 <= a <= 1 and (a == 1 or allowed(a + 1e-9)) and (a < 2e-6 or not allowed(a - 2e-6))


def test_schedule(spark):
    sizes = {"big": 400, "mid": 60, "small": 25, None: 10, "": 5}
    rows, n = [], 0
    for source, count in sizes.items():
        for k in range(count):
            rows.append((n, " ".join(["w"] * (1 + n % 7)), source, "clash"))
            n += 1
    rows += [(9000, None, "big", "x"), (9001, " \n", "empty", "x"), (0, rows[0][1], "big", "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, key string")
    out = mix_sources(frame, target_entropy=0.95, max_epochs=3.0, block_tokens=50).collect()
    read = Counter(r["doc_id"] for r in out)
    assert all(read[i] >= 1 for i, *_ in rows)  # nothing is left out
    assert max(read.values()) <= 2 * 4
    tokens, used, weight = Counter(), Counter(), {}
    for i, text, source, _ in rows:
        tokens[source] += len((text or "").split())
    for r in out:
        used[r["source"]] += r["n_tokens"]
        weight[r["source"]] = r["weight"]
    total = sum(used.values())
    for source in sizes:
        assert abs(used[source] - weight[source] * total) < 8 + 0.01 * total * weight[source]
        assert used[source] <= 3.0 * tokens[source] + 8
    assert abs(sum(weight.values()) - 1) < 1e-6 and weight["empty"] == 0
    epochs = defaultdict(list)
    for r in out:
        epochs[r["source"], r["epoch"]].append((r["unit_order"], r["doc_order"], r["doc_id"]))
    first, second = (
        [d for _, _, d in sorted(epochs["small", e])] for e in (0, 1)
    )
    assert sorted(first) != first and second[:5] != first[:5]  # permuted, and anew in each epoch


def test_budget_and_empty_table(spark):
    frame = spark.createDataFrame([(i, "a b c d", f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    out = mix_sources(frame, budget=600)
    assert 600 <= out.agg(F.sum("n_tokens")).first()[0] <= 612
    assert mix_sources(frame.limit(0)).collect() == []


# ---- revisits --------------------------------------------------------------

def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.org:80/Path/?utm_source=x&b=2&utm_term=y#top": "example.org/Path/?b=2",
        "https://example.org/": "example.org", "example.org": "example.org", "https://a.org/x/?utm_a=1": "a.org/x",
        "": "", "https://a.org:443/p?q=1&utm_z": "a.org/p?q=1",
    }
    frame = spark.createDataFrame([(k,) for k in cases] + [(None,)], "u string")
    assert {r[0]: r[1] for r in frame.select("u", canonical_url(F.col("u"))).collect()} == cases | {None: None}


def test_revisits(spark):
    def fields(**named):
        return [(k.replace("_", "-"), v) for k, v in named.items()]

    u = "https://a.org/x"
    rows = [
        (1, "response", u, 100, fields(ETag='"v1"', Content_Type="text/html", Date="100", Set_Cookie="a")),
        (2, "response", u, 5000, fields(etag='"v2"', Last_Modified="monday", Date="5000")),
        (3, "response", u, 5000, fields(ETag='W/"v3"', Last_Modified="monday")),
        (10, "revisit", "http://a.org/x/", 99, fields(ETag='"v1"')),
        (11, "revisit", u, 100, fields(ETag='"v1"')),
        (12, "revisit", u, 4999, fields(ETag='W/"v1"', DATE="4999", Content_Type="no", Expires="soon")),
        (13, "revisit", u, 5001, fields(ETag='"v1"')),
        (14, "revisit", u, 90000, fields(Last_Modified="monday")),
        (15, "revisit", u, 90001, fields(Last_Modified="sunday")),
        (16, "revisit", u, 90002, None),
        (17, "revisit", None, 90003, fields(ETag='"v1"')),
        (18, "other", u, 90004, None),
        (16, "revisit", u, 90002, None),
    ]
    shape = "record_id long, kind string, url string, at long, headers array<struct<name:string,value:string>>"
    out = resolve_revisits(spark.createDataFrame(rows, shape)).collect()
    found = sorted((r["record_id"], r["response_id"], r["outcome"]) for r in out if r["record_id"] != 17)
    assert found == [
        (10, None, "orphan"), (11, None, "orphan"), (12, 1, "resolved"), (13, 3, "changed"), (14, 3, "resolved"),
        (15, 3, "changed"), (16, 3, "unvalidated"), (16, 3, "unvalidated"),
    ] if (11, None, "orphan") in found else None
    assert [r["outcome"] for r in out if r["record_id"] == 17] == ["orphan"]
    merged = next(r for r in out if r["record_id"] == 12)["headers"]
    assert [tuple(h) for h in merged] == [
        ("Content-Type", "text/html"), ("Set-Cookie", "a"), ("ETag", 'W/"v1"'), ("DATE", "4999"), ("Expires", "soon")]
    assert resolve_revisits(spark.createDataFrame([], shape)).collect() == []


def test_busy_address_is_resolved_over_many_slices(spark):
    """A third of all records on one address; against the latest earlier response by plain search."""
    rows, empty = [], []
    for i in range(900):
        url = "https://busy.org/" if i % 3 else f"https://x{i % 50}.org/"
        rows.append((i, "revisit" if i % 4 else "response", url, (i * 7919) % 100000, [("ETag", '"same"')] if i % 4 else [("etag", '"same"')]))
    shape = "record_id long, kind string, url string, at long, headers array<struct<name:string,value:string>>"
    found = {r["record_id"]: r["response_id"] for r in resolve_revisits(spark.createDataFrame(rows, shape)).collect()}
    for i, kind, url, at, _ in rows:
        if kind == "revisit":
            earlier = [(t, j) for j, k, u, t, _ in rows if k == "response" and u == url and t < at]
            assert found[i] == (max(earlier)[1] if earlier else None)
    assert not empty


# ---- decontamination -------------------------------------------------------

ITEM = "Anna bought 12 apples for 3 dollars each and Anna then gave 5 of the apples to Robert before the long trip home."
FILLER = "quite other words stand here that say nothing at all about it and go on for a while longer until the end. "


def test_templates():
    t = Template([ITEM, "", None, "... !!"], {})
    kinds = dict(zip(t.words(0, len(t.codes)), t.kinds(0, len(t.codes))))
    assert kinds["12"] == 1 and kinds["dollars"] == 3 and kinds["robert"] == 4 and kinds["apples"] == 0
    assert t.kinds(0, 1) == [0] and t.kinds(9, 10) == [4]  # the first word of a sentence is no name, the tenth is
    assert set(t.owner.tolist()) == {0}


def test_slots_must_be_consistent():
    assert consistent_share(["anna", "x", "anna"], ["mary", "x", "mary"], [4, 0, 4]) == 1.0
    assert consistent_share(["anna", "anna", "bob"], ["mary", "jane", "jane"], [4, 4, 4]) < 0.8
    assert consistent_share(["a"], ["b"], [0]) == 1.0


def test_contaminated(spark):
    renamed = ITEM.replace("Anna", "Maria").replace("Robert", "Peter").replace("12", "40").replace(" 5 ", " 7 ")
    mixed = ITEM.replace("Anna", "Maria").replace("Robert", "Maria").replace("12", "4").replace(" 3 ", " 4 ").replace(" 5 ", " 4 ")
    docs = [
        (1, FILLER + ITEM + " " + FILLER), (2, FILLER + renamed), (3, FILLER), (4, None), (5, ""), (6, FILLER + ITEM[:40] + FILLER),
        (7, renamed.upper()), (8, "what is it"), (9, "what is that"), (10, FILLER * 400 + ITEM), (None, ITEM), (1, FILLER + ITEM + " " + FILLER),
        (11, FILLER + mixed),
    ]
    items = [(100, ITEM), (101, "What is it?"), (102, None), (103, ""), (104, "1 2 3 4 5 6 7 8 9 10"), (100, ITEM)]
    frame = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, key long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted({(r["doc_id"] or -1, r["item_id"]) for r in contaminated(frame, bench).collect()})
    assert (1, 100) in found and (2, 100) in found and (10, 100) in found and (-1, 100) in found and (8, 101) in found
    assert not {3, 4, 5, 6, 9, 11} & {d for d, _ in found}
    frame = frame.withColumns({"__key": F.lit(1), "Row_Key": F.lit(2)})
    kept = decontaminate(frame, bench)
    assert kept.columns == frame.columns
    assert {3, 4, 5, 6, 9, 11} <= {r["doc_id"] for r in kept.collect()}
    assert not {1, 2, 8, 10, None} & {r["doc_id"] for r in kept.collect()}
    assert contaminated(frame.limit(0), bench).collect() == []
    assert contaminated(frame, bench.limit(0)).collect() == []


def test_number_tables_are_no_templates(spark):
    docs = spark.createDataFrame([(1, " ".join(str(i * 37) for i in range(60))), (2, "1 2 3 4 5 6 7 8 9 10")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "1 2 3 4 5 6 7 8 9 10")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()] == [(2, 7)]


def test_edited_copies_are_found(spark):
    item = " ".join(f"w{i}x" for i in range(59)).split()
    put = {
        1: item[:29] + ["other"] + item[30:], 2: item[:29] + ["other"] + item[29:], 3: item[:29] + item[30:],
        4: item[:19] + ["a"] + item[20:39] + ["b"] + item[40:], 5: item[30:] + item[:29], 6: item[:29] + ["other"] * 40 + item[29:],
        7: item[:29],
    }
    docs = spark.createDataFrame([(i, FILLER * 20 + " ".join(w) + " " + FILLER) for i, w in put.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"]: r["coverage"] for r in contaminated(docs, bench).collect()}
    assert set(found) == {1, 2, 3, 4}
    assert found[1] == found[3] == pytest.approx(58 / 59) and found[2] == 1.0 and found[4] == pytest.approx(57 / 59)


def test_renamed_subjects_and_spellings_are_found(spark):
    first = "Tom has 5 apples. Tom buys 3 more. Tom eats 2 today. Then Tom gives 4 away. How many apples are left?"
    second = "Every morning Tom walks 5 km to school and pays 12 dollars for lunch before Tom runs 3 km back to his house."
    docs = [
        (1, first.replace("Tom", "Ann").replace("5", "9")), (2, first.replace("Tom", "Mary Ann")),
        (3, second.replace("Tom", "Mary Ann").replace(" km", "km")), (4, second.replace("12 dollars", "$12").replace("Tom", "Zoe")),
        (5, first.replace("Tom has", "Ann has").replace("Tom buys", "Bob buys").replace("Tom eats", "Joe eats").replace("Tom gives", "Liz gives")),
        (6, "Then some " + first.lower()),
    ]
    frame = spark.createDataFrame([(i, FILLER + "So it is. " + t + " " + FILLER) for i, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(1, first), (2, second)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contaminated(frame, bench).collect()}
    assert found >= {(1, 1), (2, 1), (3, 2), (4, 2)} and not {d for d, _ in found} & {5}


# ---- language identification -----------------------------------------------

TEXTS = {
    "en": "the house and the river are old but the people there will always remember what was said",
    "de": "das haus und der fluss sind alt aber die leute dort werden immer daran denken was gesagt wurde",
    "fr": "la maison et le fleuve sont vieux mais les gens là-bas se souviendront toujours de ce qui était dit",
}


def test_language(spark):
    rows = [(i, TEXTS[x], x, "s") for i, x in enumerate(list(TEXTS) * 8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, word string")
    model = train(frame)
    assert model.langs == ["de", "en", "fr"]
    new = [(1, "the rivers remembered"), (2, "häuser und leute"), (3, "toujours vieux"), (4, None), (5, ""), (6, "12 %% 3"), (7, "zzzz"), (None, "la maison")]
    out = {r["doc_id"]: r for r in identify(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert [out[i]["lang_pred"] for i in (1, 2, 3, None)] == ["en", "de", "fr", "fr"]
    assert [(out[i]["lang_pred"], out[i]["score"]) for i in (4, 5, 6)] == [("und", 0.0)] * 3
    assert out[7]["lang_pred"] in model.langs and all(0 <= r["score"] <= 1 for r in out.values())


def test_backoff_goes_from_long_to_short_grams(spark):
    model = train(spark.createDataFrame([("en", "strong strong"), ("de", "lang lang")], "lang string, text string"))
    assert model.word("strong")[1] > model.word("strong")[0]
    assert model.word("strange")[1] > model.word("strange")[0]  # by its 4-grams ^str and stra's neighbours
    assert (model.word("0") == 0).all()


def test_held_out_documents_and_small_model(spark):
    rows = [(i, TEXTS[x] if i % 2 else TEXTS[x].upper(), x if i % 5 else None) for i, x in enumerate(list(TEXTS) * 20)]
    frame = spark.createDataFrame([*rows, (None, TEXTS["de"], "de")], "doc_id long, text string, lang string")
    out = held_out_language_id(frame).collect()
    import zlib

    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, *_ in rows}
    truth = {i: list(TEXTS)[i % 3] for i, *_ in rows}
    assert len(out) == 61 and all(r["held_out"] == held.get(r["doc_id"], False) for r in out)
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in out if r["doc_id"] is not None)
    small = train(frame, max_cells=60)
    assert len(small.words.entries) <= 20 and len(small.grams.entries) <= 20
    assert held_out_language_id(frame.limit(0)).collect() == []
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in held_out_language_id(unlabelled).collect()} == {("und", 0.0)}


def test_rare_words_stay_known(spark):
    rows = [(i, TEXTS[x], x) for i, x in enumerate(list(TEXTS) * 8)] + [(90, "qoph qoph zayin", "fr"), (91, "zayinu samekh", "de")]
    new = [(1, "qoph"), (2, "samekh zayin"), (3, "häuser und leute rivers"), (4, None), (5, "12 %"), (6, "toujours zayins sameks"), (7, "日本"), (None, "qoph the")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = spark.createDataFrame(new, "doc_id long, text string")
    whole = train(frame)  # small enough for every word and n-gram to be packed
    wanted = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs, whole).collect()}
    cut = identify(docs, train(frame, max_cells=60)).where("doc_id = 1").first()
    assert cut["score"] != pytest.approx(wanted[1][1], abs=1e-4)  # a bounded table does not know the word
    for cells in (0, 60, 400_000):
        found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_whole(docs, count(frame), max_cells=cells).collect()}
        assert found.keys() == wanted.keys() and found[1][0] == "fr"
        for i, (lang, share) in wanted.items():
            assert found[i][0] == lang and found[i][1] == pytest.approx(share, abs=1e-4)


def test_texts_of_numerals_have_no_language(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(9)] + [(100 + i, t, "en") for i, t in enumerate(["½ ² Ⅷ", "①②", "12 _", "x½"])]
    out = {r["doc_id"]: r for r in held_out_language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [out[i]["lang_pred"] for i in range(100, 104)] == ["und", "und", "und", "en"]


def test_words_of_plain_texts_need_no_list_of_numerals(monkeypatch):
    texts = ["The cat_sat 12 times", "Größe, Maß 12 und là-bas", "x½y Ⅷth Ünder", "日本 ٣x", "", None, "\x1c ǅ ʰ İx"]
    wanted = [language_id._LETTERS.findall(t.lower()) if t else [] for t in texts]
    assert [language_id.words_of(t) for t in texts] == wanted
    monkeypatch.setattr(language_id, "_LETTERS", None)
    assert [language_id.words_of(t) for t in texts[:2]] == wanted[:2]


def test_counts_are_passed_on_in_parts_and_grams_are_counted_before_they_are_rows(spark, monkeypatch):
    from collections import Counter

    rows = [(TEXTS[x] + " naïve 日本 a ab", x) for x in TEXTS] * 3 + [("no language", None), (None, "en"), ("", "xx")]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    words = Counter((x, w) for t, x in rows if x for w in language_id.words_of(t))
    grams = Counter()
    for (x, w), n in words.items():
        for size in range(1, 4):
            for gram in language_id.grams_of(w, size):
                grams[x, gram] += n
    for held in (1, 40, 10**6):
        monkeypatch.setattr(language_id, "_FLUSH", held)
        found = language_id.word_counts(frame, "text", "lang")
        assert {(r["lang"], r["word"]): r["n"] for r in found.collect()} == words
        cut = language_id.gram_counts(found, 3)
        assert {(r["lang"], r["word"]): r["n"] for r in cut.collect()} == grams
        assert "Generate" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_counts_and_shuffles_are_removed_before_documents_are_scored(spark, monkeypatch):
    written, inner = [], language_id.stored

    def recorded(frame, name, **options):
        written.append((name, inner(frame, name, **options)))
        return written[-1][1]

    monkeypatch.setattr(language_id, "stored", recorded)
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = [(i, TEXTS[x] + f" own{i}", x) for i, x in enumerate(list(TEXTS) * 10)]
    found = held_out_language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    there = lambda f: (p := path(f)).getFileSystem(conf).exists(p)
    left = {name for name, out in written if any(map(there, out.inputFiles()))}
    assert {"words", "grams", "frequent"} <= {name for name, _ in written} and not {"words", "grams", "frequent"} & left
    assert {"blocks", "known_words"} <= left
    assert {r["doc_id"]: r["lang_pred"] for r in found.collect()} == {i: x for i, _, x in rows}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_passing_tables(spark):
    with passing_tables(spark):
        with passing_tables(spark):
            passing, kept = stored(spark.range(3), "passing"), stored(spark.range(4), "kept", lasting=True)
        with pytest.raises(Exception, match="(?i)file"):
            passing.collect()
        assert kept.count() == 4
    with pytest.raises(Exception, match="(?i)file"):
        kept.collect()
    with pytest.raises(ValueError), passing_tables(spark):
        failed = stored(spark.range(2), "failed")
        raise ValueError
    with pytest.raises(Exception, match="(?i)file"):
        failed.collect()
    assert stored(spark.range(5), "alone", lasting=True).count() == 5
