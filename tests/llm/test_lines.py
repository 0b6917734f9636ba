"""Line dedup against brute force, and its corner cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import line_dedup as line_dedup_module
from ordermart.llm.line_dedup import band_keys, joining_links, line_dedup, similar, small_bucket_links


def normal(line):
    return " ".join(line.lower().split())


def brute(rows):
    """Expected texts of (id, text) rows; identifiers are distinct and not null."""
    places = [(i, at, raw) for i, t in sorted(rows) if t is not None for at, raw in enumerate(t.split("\n")) if normal(raw)]
    distinct = sorted({normal(raw) for _, _, raw in places})
    parent = {x: x for x in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, x in enumerate(distinct):
        for y in distinct[:n]:
            if similar(x, y):
                parent[root(x)] = root(y)
    seen, gone = set(), set()
    for i, at, raw in places:
        c = root(normal(raw))
        if c in seen:
            gone.add((i, at))
        seen.add(c)
    return {
        i: None if t is None else "\n".join(raw for at, raw in enumerate(t.split("\n")) if (i, at) not in gone)
        for i, t in rows
    }


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("st", "nd", "rr", "l")]
    pool = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 60))) for _ in range(80)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 8)):
            line = rng.choice(pool) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 70)))
            if rng.random() < 0.4:
                parts = line.split()
                parts[rng.randrange(len(parts))] = "changed"
                line = " ".join(parts)
            lines.append(line.upper() if rng.random() < 0.1 else line)
        rows.append((i, "\n".join(lines)))
    return rows


def test_banding_recall():
    rng = random.Random(1)
    hit = total = 0
    for _ in range(400):
        line = "".join(rng.choice("abcdefgh ij") for _ in range(rng.randint(60, 400)))
        at = rng.randrange(len(line))
        other = line[:at] + "".join(rng.choice("xyz") for _ in range(rng.randint(1, max(1, len(line) // 16)))) + line[at:]
        if similar(line, other):
            total += 1
            hit += bool((band_keys([line])[0] == band_keys([other])[0]).any())
    assert total > 150 and hit / total > 0.99


def test_keys_do_not_depend_on_the_batch():
    lines = ["", "a", "some line of text", "ünïcode " * 9, "some line of text"]
    together = band_keys(lines)
    assert all((together[i] == band_keys([x])[0]).all() for i, x in enumerate(lines))


def test_equals_brute_force(spark):
    rows = corpus(2) + [(100, None), (101, ""), (102, "\n\n"), (103, "One\n one \n\nTwo words\nONE")]
    frame = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, k long, line string")
    frame = frame.withColumns({"gone": F.lit(1), "Row_Key": F.lit(2), "__gone": F.lit(3)})
    found = line_dedup(frame)
    assert found.columns == ["doc_id", "text", "k", "line", "gone", "Row_Key", "__gone"]
    assert {r["doc_id"]: r["text"] for r in found.collect()} == brute(rows)


def test_repeated_rows_missing_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "same line here"), (1, "same line here"), (1, "same line here"), (2, "other")], "doc_id long, text string")
    found = sorted(line_dedup(frame).collect(), key=repr)
    assert [tuple(r) for r in found] == sorted([(None, "same line here"), (1, ""), (1, ""), (2, "other")], key=lambda t: f"Row(doc_id={t[0]}, text={t[1]!r})")
    assert line_dedup(frame.limit(0)).collect() == []


def test_chain_in_one_bucket_is_joined(spark):
    base = [f"word{i:03d}" for i in range(40)]
    chain = [" ".join(base[:k] + [f"new{j:03d}" for j in range(40 - k)]) for k in range(40, 28, -2)]
    rows = list(enumerate(chain))
    found = {r[0]: r[1] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows)


def test_joining_links_connect_what_all_pairs_connect():
    rng = random.Random(6)
    for _ in range(20):
        base = [f"w{rng.randrange(90)}" for _ in range(30)]
        lines = []
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(30)] = f"x{rng.randrange(90)}"
            lines.append(" ".join(words))
        lines = sorted(set(lines)) + ["short", "shorter"]

        def labels(pairs):
            parent = list(range(len(lines)))

            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for x, y in pairs:
                parent[max(root(x), root(y))] = min(root(x), root(y))
            return [root(x) for x in range(len(lines))]

        everything = [(x, y) for y in range(len(lines)) for x in range(y) if similar(lines[x], lines[y])]
        found = joining_links(lines, np.arange(len(lines)))
        assert labels(found) == labels(everything) and len(found) < len(lines)
        settled = [(x, y) for x, y in everything if x == 0]
        others = small_bucket_links(lines, np.arange(len(lines)), [(np.arange(len(lines)), 1)])
        assert labels(settled + others) == labels(everything)


def test_very_long_lines_and_a_very_common_line(spark, monkeypatch):
    monkeypatch.setattr(line_dedup_module, "_CHUNK_SHINGLES", 1 << 12)
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40_000))
    rows = [(i, "the very common line\n" + f"own line {i * 7919} of its document") for i in range(300)]
    rows += [(400, long), (401, long[:-40]), (402, "x" + long), (403, "\n".join(["the very common line"] * 50))]
    found = {r[0]: r[1] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert found == brute(rows)


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup_module, "BLOCK", 16)
    rng = random.Random(12)
    base = [f"word{rng.randrange(500)}" for _ in range(40)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(40)] = f"new{rng.randrange(500)}"
        rows.append((i, " ".join(words)))
    found = {r[0]: r[1] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows)


def test_bands_are_shuffled_once_and_not_written(spark, monkeypatch):
    written, inner = [], line_dedup_module.stored

    def recorded(frame, name, **options):
        out = inner(frame, name, **options)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(line_dedup_module, "stored", recorded)
    rng = random.Random(9)
    alone = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(40)]
    pair = alone[:2] + [alone[0] + "s", alone[1] + " e"]
    group = [alone[2] + end for end in ("a", "b", "c", "d")]
    rows = list(enumerate(alone + pair + group))
    found = {r[0]: r[1] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows)
    sizes = dict(written)
    assert not {"bands", "buckets"} & set(sizes)
    assert 0 < sizes["members"] <= 16 * 9  # of the lines that are alike only


def test_normal_lines_are_those_of_each_line():
    texts = ["", " ", "\n", "A b\nC d", "a  b\nc", "a \nb", "a\n b", " a", "a\r\nb", "a\tb", "x\u00a0y\nz", "x\u2028y", "x\u0085y", "ΑΣ\nΣΑΣ", "\u0130i\nß", "\x1f"]
    for text in texts:
        assert line_dedup_module.normal_lines(text) == [normal(raw) for raw in text.split("\n")]


def test_texts_of_lines_are_kept_once_and_scratch_tables_go(spark, monkeypatch):
    written, inner = [], line_dedup_module.stored

    def recorded(frame, name, **options):
        written.append((name, inner(frame, name, **options)))
        return written[-1][1]

    monkeypatch.setattr(line_dedup_module, "stored", recorded)
    rng = random.Random(21)
    alone = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(30)]
    rows = list(enumerate(alone + [alone[0] + "s", "\n".join(["again", "again"]), "again"]))
    frame = line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    columns = {name: out.columns for name, out in written}
    assert "line" not in columns["distinct_lines"]
    # The result reads the one table that tells which lines go; the others are no longer there.
    left = [name for name, out in written if files_of(spark, out)]
    assert left == ["gone"]
    assert {r[0]: r[1] for r in frame.collect()} == brute(rows)


def files_of(spark, frame):
    """Files of a stored table that are still there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return [f for f in frame.inputFiles() if (p := path(f)).getFileSystem(conf).exists(p)]


def test_bands_of_many_buckets_and_of_lines_shown_in_many_chunks(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(12)]
    rows = [(i, "\n".join([base[i % 12], base[i % 5] + f" {i % 7}", "of all"])) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    plain = {r[0]: r[1] for r in line_dedup(docs).collect()}
    monkeypatch.setattr(line_dedup_module, "_BUCKET_BANDS", 16)
    monkeypatch.setattr(line_dedup_module, "_DEALT_BANDS", 64)
    monkeypatch.setattr(line_dedup_module, "_SIGN_CHARS", 200)
    assert plain == {r[0]: r[1] for r in line_dedup(docs).collect()} == brute(rows)
    cut = line_dedup_module.cut_lines(docs.selectExpr("cast(doc_id as string) id", "doc_id row_key", "text")).cache()
    found = [tuple(r) for r in line_dedup_module.shared_bands(cut, 40, shingle=8, bands=16, rows=5).collect()]
    assert len(found) == len({(band, k) for band, k, _, _ in found})  # a line is in its band once
    assert all(leader == min(k for b, k, _, _ in found if b == band) for band, _, leader, _ in found)


def test_plain_lines_are_compared_as_packed_numbers(monkeypatch):
    """Same verdict as on sets of texts; lines of one byte a character never become such sets."""
    sets, rng = line_dedup_module._shingles, random.Random(5)
    base = ["hello there, a line of text " * 2, "ünïcode " * 6, "日本語テキスト " * 4, "short", "short\0", "abc\0", "abc", "\0" * 9]
    pairs = []
    for _ in range(600):
        x = rng.choice(base)
        y = list(rng.choice([x, rng.choice(base)]))
        for _ in range(rng.randint(0, 3)):
            y[rng.randrange(len(y))] = rng.choice("ab é日\0")
        pairs.append((x, "".join(y)))
    for x, y in pairs:
        for shingle in (1, 3, 8, 9):
            a, b = sets(x, shingle), sets(y, shingle)
            for least in (0.3, 0.8, 1):
                assert similar(x, y, least, shingle) == (len(a & b) >= least * len(a | b))
    monkeypatch.setattr(line_dedup_module, "_shingles", None)
    assert similar(base[0], base[0] + "x") and similar(base[1], base[1]) and not similar(base[0], base[1])


def test_candidates_of_any_script_are_verified(spark):
    """Plain and other lines side by side, each with a near copy and with one that is not near enough."""
    lines = ["some words that are in every line of this page " * 2, "日本語のテキストがここにあります、" * 5, "naïve “quoted” words — and more of them " * 2]
    near = [x + "!" for x in lines]
    far = [x[:len(x) // 2] + "0123456789 other end " * 3 for x in lines]
    texts = [(k, x) for k, x in enumerate(lines + near + far)]
    places = spark.createDataFrame(texts, "k long, line string")
    pairs = spark.createDataFrame([(n, n + 3 * m) for n in range(3) for m in (1, 2)], "a long, b long")
    found = line_dedup_module._verified(pairs, places, 0.8, 8).collect()
    assert sorted((r.a, r.b) for r in found) == [(0, 3), (1, 4), (2, 5)]
