"""Language identification: word-first backoff.

A known word is scored by its log frequency in each language; an unseen word by
the mean log frequency of its longest known character n-grams, with shorter ones
asked only while no longer one is known. Words are lower-cased runs of letters,
and n-grams see the word with its edges marked.

Counts cover all training documents and stay whole, as tables (``Counts``).
``identify_whole`` packs documents into blocks; the most frequent words, as many as
``max_cells`` (entries times languages) allows, are looked up in the tasks, all
others are joined by distinct word with the word counts and, where they are unseen,
with the n-gram counts. Where the packed table ends does not change the result.

``train`` gives a ``Model`` of bounded size instead: the most frequent words and
n-grams, cut at the smallest power of two of the count that meets ``max_cells``. A
word below that cut is an unseen word. No query uses it.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import Numbering, passing_tables, stored

LONGEST, SMOOTHING = 4, 0.5
#: Entries times languages of a packed table of words or n-grams; the driver holds it while it packs it.
MAX_CELLS = 400_000
UNKNOWN = "und"
#: Signs that count as word characters without being letters or decimal digits, such as fractions and Roman numerals.
_NUMERALS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Nl", "No"))
_LETTERS = re.compile(rf"[^\W\d_{_NUMERALS}]+")
#: The same without these signs, whose long list is slow to match; texts that hold none of them are cut by these.
_ASCII, _PLAIN = re.compile("[a-z]+"), re.compile(r"[^\W\d_]+")
#: Counts a task holds before it passes them on, words remembered, and characters of a block of documents.
_FLUSH, _CACHE, _CHUNK_CHARS = 400_000, 200_000, 1 << 21


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    if text.isascii():
        return _ASCII.findall(text)
    words = _PLAIN.findall(text)
    return words if all(map(str.isalpha, words)) else _LETTERS.findall(text)


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of the word with its edges marked; single characters without the marks."""
    if n == 1:
        return list(word)
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _passed_on(seen: dict[str, dict[str, int]]) -> pd.DataFrame:
    """The counts by language and word as rows; ``seen`` is empty afterwards."""
    out = pd.DataFrame({
        "lang": pd.Series(chain.from_iterable(repeat(lang, len(of)) for lang, of in seen.items()), dtype=object),
        "word": pd.Series(chain.from_iterable(seen.values()), dtype=object),
        "n": np.fromiter(chain.from_iterable(of.values() for of in seen.values()), np.int64),
    })
    seen.clear()
    return out


def word_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, word, n) over all rows with a language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, held = defaultdict(Counter), 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                of = seen[lang]
                held -= len(of)
                of.update(words_of(text))
                held += len(of)
                if held > _FLUSH:
                    yield _passed_on(seen)
                    held = 0
        yield _passed_on(seen)

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _grams(size: int) -> Column:
    """What ``grams_of`` gives for the column ``word``."""
    text = F.col("word") if size == 1 else F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    cut = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, cut).otherwise(F.array().cast("array<string>"))


def gram_counts(counts: DataFrame, longest: int) -> DataFrame:
    """(lang, word, n) of the n-grams of the counted words, an n-gram standing as its word."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, held = defaultdict(lambda: defaultdict(int)), 0
        for batch in batches:
            for lang, word, n in zip(batch["lang"], batch["word"], batch["n"].tolist()):
                of = seen[lang]
                held -= len(of)
                for size in range(1, longest + 1):
                    for gram in grams_of(word, size):
                        of[gram] += n
                held += len(of)
                if held > _FLUSH:
                    yield _passed_on(seen)
                    held = 0
        yield _passed_on(seen)

    rows = counts.select("lang", "word", "n").mapInPandas(cut, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Lookup:
    """Log frequencies by language of the most frequent entries."""

    def __init__(self, table: pd.DataFrame, langs: list[str], totals: dict):
        entries = {w: i for i, w in enumerate(sorted(set(table["word"])))}
        counts = np.zeros((len(entries), len(langs)), np.float64)
        column = {lang: i for i, lang in enumerate(langs)}
        counts[[entries[w] for w in table["word"]], [column[x] for x in table["lang"]]] = table["n"]
        sizes = np.array([[totals.get((x, g), 0.0) for x in langs] for g in self.groups(entries)])
        self.entries = entries
        self.rows = np.log((counts + SMOOTHING) / (sizes + SMOOTHING * (len(entries) + 1))).astype(np.float32) \
            if len(entries) else np.zeros((0, len(langs)), np.float32)

    def groups(self, entries: dict) -> list[int]:
        return [0] * len(entries)


class GramLookup(Lookup):
    def groups(self, entries: dict) -> list[int]:
        return [len(g) for g in entries]


class Model:
    """Scores of words in every language."""

    def __init__(self, langs: list[str], words: Lookup, grams: Lookup, longest: int):
        self.langs, self.words, self.grams, self.longest = langs, words, grams, longest

    def word(self, word: str) -> np.ndarray:
        at = self.words.entries.get(word)
        if at is not None:
            return self.words.rows[at]
        known = self.grams.entries
        for n in range(self.longest, 0, -1):
            found = [known[g] for g in grams_of(word, n) if g in known]
            if found:
                return self.grams.rows[found].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)

    def predict(self, texts: list[str | None], cache: dict) -> tuple[list[str], np.ndarray]:
        """Language and its share of the posterior, all languages equally likely at first."""
        distinct, parts = Numbering(), [np.zeros(0, np.int64)]
        for text in texts:
            words = words_of(text)
            parts.append(np.fromiter(map(distinct.__getitem__, words), np.int64, len(words)))
        codes, counts = np.concatenate(parts), np.array([len(p) for p in parts[1:]], np.int64)
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not len(codes) or not self.langs:
            return langs, scores
        if len(cache) > _CACHE:
            cache.clear()
        rows = np.empty((len(distinct), len(self.langs)), np.float64)
        for i, word in enumerate(distinct):
            row = cache.get(word)
            if row is None:
                row = cache[word] = self.word(word)
            rows[i] = row
        some = np.nonzero(counts)[0]
        starts = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
        sums = np.stack([np.add.reduceat(rows[codes, j], starts) for j in range(len(self.langs))], axis=1)
        best = sums.argmax(axis=1)
        share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        for i, b, s in zip(some, best, share):
            langs[i], scores[i] = self.langs[b], s
        return langs, scores


def _table(counts: DataFrame, langs: int, max_cells: int) -> pd.DataFrame:
    """Rows of the most frequent words, as many as ``max_cells`` allows."""
    totals = counts.groupBy("word").agg(F.sum("n").alias("all"))
    limits = [1 << i for i in range(0, 62)]
    found = totals.agg(*[F.count(F.when(F.col("all") >= x, 1)).alias(str(x)) for x in limits]).first()
    least = next(x for x in limits if found[str(x)] * langs <= max_cells)
    frequent = stored(totals.where(F.col("all") >= least).select("word"), "frequent")
    return counts.join(frequent, "word").select("lang", "word", "n").toPandas()


@dataclass
class Counts:
    """Whole counts of words and n-grams, and their sums by language and size (0 for words)."""

    langs: list[str]
    words: DataFrame
    grams: DataFrame
    totals: dict[tuple[str, int], int]
    longest: int


def count(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST) -> Counts:
    """Count the rows of ``docs`` that name a language."""
    words = stored(word_counts(docs, text_col, lang_col), "words", compression="zstd")
    grams = stored(gram_counts(words, longest), "grams", compression="zstd")
    totals = {(r["lang"], 0): r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(x for x, _ in totals)
    by_size = grams.groupBy("lang", F.length("word").alias("size")).agg(F.sum("n").alias("n"))
    totals |= {(r["lang"], r["size"]): r["n"] for r in by_size.collect()}
    return Counts(langs, words, grams, totals, longest)


def train(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, max_cells: int = MAX_CELLS
) -> Model:
    """Learn a model of bounded size from the rows of ``docs`` that name a language."""
    counts = count(docs, text_col=text_col, lang_col=lang_col, longest=longest)
    langs, width = counts.langs, max(1, len(counts.langs))
    return Model(
        langs, Lookup(_table(counts.words, width, max_cells), langs, counts.totals),
        GramLookup(_table(counts.grams, width, max_cells), langs, counts.totals), longest,
    )


# ---- the whole counts ------------------------------------------------------
# The score of a word in a language is a base by its size (0 for known words, else that of its known n-grams)
# and language, and the excess over a count of none, which is kept for the languages that have the word.

def _base(counts: Counts) -> np.ndarray:
    """Log share of a count of none by size and language; the last row, of words without any known n-gram, is zero."""
    entries = [table.select("word").distinct().count() for table in (counts.words, counts.grams)]
    base = np.zeros((counts.longest + 2, len(counts.langs)))
    for size in range(counts.longest + 1):
        for i, lang in enumerate(counts.langs):
            base[size, i] = np.log(SMOOTHING / (counts.totals.get((lang, size), 0) + SMOOTHING * (entries[size > 0] + 1)))
    return base


def _rows_of_words(wanted: DataFrame, counts: Counts) -> DataFrame:
    """(word, size, langs, excess) of every word of ``wanted`` (word), whatever its frequency."""
    number = (F.array_position(F.array(*[F.lit(x) for x in counts.langs]), F.col("lang")) - 1).cast("int")
    excess = F.log((F.col("n") + SMOOTHING) / SMOOTHING)

    def rows(table: DataFrame) -> DataFrame:
        return table.select("word", F.struct(number.alias("lang"), excess.alias("excess")).alias("row"))

    found = wanted.join(rows(counts.words), "word", "left").groupBy("word").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    found = stored(found.withColumn("id", F.monotonically_increasing_id()), "known_words", compression="zstd", lasting=True)
    out = found.where(F.size("rows") > 0).select("word", F.lit(0).alias("size"), "rows")
    open_words = found.where(F.size("rows") == 0).select("id", "word")
    grams = rows(counts.grams).groupBy(F.col("word").alias("gram")).agg(F.collect_list("row").alias("rows"))
    for size in range(counts.longest, 0, -1):
        # A gram that a word holds twice counts twice in the mean.
        pieces = open_words.select("id", F.explode(_grams(size)).alias("gram")).groupBy("id", "gram").agg(F.count("*").alias("times"))
        of_size = grams.where(F.length("gram") == size)
        # Every piece counts its times once, beside the first of its rows.
        hits = pieces.join(of_size, "gram").select("id", "times", F.posexplode("rows").alias("at", "row"))
        sums = hits.groupBy("id", "row.lang").agg(
            F.sum(F.col("times") * F.col("row.excess")).alias("sum"), F.sum(F.when(F.col("at") == 0, F.col("times"))).alias("times")
        )
        means = sums.groupBy("id").agg(
            F.sum("times").alias("all"), F.array_sort(F.collect_list(F.struct("lang", "sum"))).alias("sums")
        )
        row = F.transform("sums", lambda r: F.struct(r["lang"].alias("lang"), (r["sum"] / F.col("all")).alias("excess")))
        means = means.select("id", row.alias("rows"))
        done = stored(open_words.join(means, "id", "left"), f"by_grams_{size}", compression="zstd", lasting=True)
        out = out.unionByName(done.where("rows is not null").select("word", F.lit(size).alias("size"), "rows"))
        open_words = done.where("rows is null").select("id", "word")
    nothing = F.array().cast(out.schema["rows"].dataType)
    out = out.unionByName(open_words.select("word", F.lit(-1).alias("size"), nothing.alias("rows")))
    return out.select("word", "size", F.col("rows.lang").alias("langs"), F.col("rows.excess").alias("excess"))


def identify_whole(
    docs: DataFrame, counts: Counts, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple = (),
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """As ``identify``, by the whole counts: every word counted is known, and every n-gram.

    Sums are compared to nine decimals, as they are added up in any order.
    """
    langs, names = counts.langs, [id_col, *keep]
    if not langs:
        return docs.select(*[f"`{n}`" for n in names], F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    # Kept columns travel as text, so that a null number is not turned into a float.
    source = docs.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names], F.col(text_col).alias("__text"))
    base = _base(counts)
    common = _table(counts.words, len(langs), max_cells)
    entries = {w: i for i, w in enumerate(sorted(set(common["word"])))}
    column = {lang: i for i, lang in enumerate(langs)}
    table = np.tile(base[0], (len(entries), 1))
    table[[entries[w] for w in common["word"]], [column[x] for x in common["lang"]]] += np.log(
        (common["n"].to_numpy(np.float64) + SMOOTHING) / SMOOTHING
    )
    del common
    shared = docs.sparkSession.sparkContext.broadcast((entries, table))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of documents, with what is left of their words by the packed table."""
        (known, scores), block = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            chars = np.cumsum([len(t) if t else 0 for t in batch["__text"]]) // _CHUNK_CHARS
            for _, part in batch.groupby(chars, sort=False):
                left = Numbering()
                sums, sizes = np.zeros((len(part), len(langs))), np.zeros(len(part), np.int32)
                owner, word, times = [], [], []
                for i, text in enumerate(part["__text"]):
                    seen = Counter(words_of(text))
                    sizes[i] = sum(seen.values())
                    at, n = [], []
                    for w, c in seen.items():
                        j = known.get(w)
                        if j is None:
                            owner.append(i)
                            word.append(left[w])
                            times.append(c)
                        else:
                            at.append(j)
                            n.append(c)
                    if at:
                        sums[i] = np.array(n, np.float64) @ scores[at]
                yield pd.DataFrame({
                    "block": [block], **{f"c{i}": [part[x].tolist()] for i, x in enumerate(names)},
                    "sizes": [sizes], "sums": [sums.ravel()], "words": [list(left)], "owner": [np.array(owner, np.int32)],
                    "word": [np.array(word, np.int32)], "times": [np.array(times, np.int32)],
                })
                block += 1

    columns = ", ".join(f"c{i} array<string>" for i in range(len(names)))
    blocks = stored(source.mapInPandas(
        pack, f"block long, {columns}, sizes array<int>, sums array<double>, words array<string>, owner array<int>, "
        "word array<int>, times array<int>",
    ), "blocks", compression="zstd", lasting=True)
    wanted = blocks.select("block", F.posexplode("words").alias("i", "word"))
    rows = _rows_of_words(wanted.select("word").distinct(), counts)
    row = F.struct("i", "size", "langs", "excess")
    joined = wanted.join(rows, "word").groupBy("block").agg(F.collect_list(row).alias("rows")).select(
        "block", F.col("rows.i").alias("i"), F.col("rows.size").alias("size"),
        F.transform("rows", lambda r: F.size(r["langs"])).alias("widths"),
        F.flatten("rows.langs").alias("langs"), F.flatten("rows.excess").alias("excess"),
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                sums = np.array(r.sums).reshape(len(r.sizes), len(langs))
                if len(r.owner):
                    own = np.zeros((len(r.i), len(langs)))
                    own[r.i] = base[r.size]
                    own[np.repeat(r.i, r.widths), r.langs] += r.excess
                    np.add.at(sums, r.owner, own[r.word] * np.asarray(r.times)[:, None])
                sums = np.round(sums, 9)
                best, some = sums.argmax(axis=1), np.asarray(r.sizes) > 0
                share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                yield pd.DataFrame({
                    **{x: getattr(r, f"c{i}") for i, x in enumerate(names)},
                    "lang_pred": [langs[b] if known else UNKNOWN for b, known in zip(best, some)],
                    "score": np.where(some, share, 0.0),
                })

    schema = ", ".join([*[f"`{n}` string" for n in names], "lang_pred string", "score double"])
    out = blocks.drop("words").join(joined, "block", "left").mapInPandas(score, schema)
    return out.withColumns({n: F.col(f"`{n}`").cast(docs.schema[n].dataType) for n in names})


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """(id, *keep, lang_pred, score) of every row.

    ``score`` is the posterior of the predicted language between 0 and 1. A text
    that is null or has no letter is ``und`` with score 0, as is every text if the
    model has learned no language. Of languages that tie the first by name is
    taken. Repeated rows are returned each, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [id_col, *keep]
    source = docs.select(*[f"`{n}`" for n in names], F.col(text_col).alias("__text"))
    kinds = [f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for batch in batches:
            sizes = np.cumsum([len(t) if t else 0 for t in batch["__text"]]) // _CHUNK_CHARS
            for _, part in batch.groupby(sizes, sort=False):
                out = part[names].copy()
                out["lang_pred"], out["score"] = shared.value.predict(part["__text"].tolist(), cache)
                yield out

    return source.mapInPandas(score, ", ".join([*kinds, "lang_pred string", "score double"]))


def held_out_language_id(docs: DataFrame) -> DataFrame:
    """Learn where crc32(doc_id) mod 3 is not 1 and predict every document; a null id counts as empty text."""
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3
    # The identifier travels as text, so that a null one is not turned into a float.
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", (rest == 1).alias("held_out"))
    # Once the words of the blocks have their rows, the counts are no longer read.
    with passing_tables(docs.sparkSession):
        found = identify_whole(named, count(docs.where(rest != 1)), keep=("held_out",))
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
