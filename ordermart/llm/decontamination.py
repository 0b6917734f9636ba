"""Benchmark decontamination by template canonicalisation.

Texts are cut into words without surrounding punctuation. Numbers, quantities,
names and units become typed placeholders; a window of canonical words is hashed,
and windows of documents are hash-joined with windows of benchmark items. All joined
windows of a document that line up with an item in the same order, along one diagonal
or along diagonals that words put in or left out have moved by a few words, count
together. What covers enough of the item is verified word by word, and the slots have
to be filled consistently: the same value of the item
always meets the same value of the document and the other way round. So a
question that was copied with other names and numbers is caught, while a text
that shares a figure of speech is not.

Every text is read twice. The first reading takes each word for itself and the first
word of a sentence for a literal. The second takes a capitalised first word for a name
unless it is a function word, a sequence of names for one name, and an amount with its
unit or sign ("5 km", "5km", "12 dollars", "$12", "12%") for one quantity, so that
renamed subjects and other spellings keep the windows. Windows of the two readings do
not mix; an item found by either is found.

Windows with few literal words say nothing as templates ("<num> <num> ..."); they
are joined by their own words instead.

The documents are read once. Their windows are first held against a bitmap of the
benchmark's windows; its size has a fixed bound, and what passes by chance is
dropped by the join, so the result is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import Numbering, fresh, stored

WINDOW, MIN_LITERALS, MIN_COVERAGE, MIN_CONSISTENCY = 8, 4, 0.6, 0.8
#: Bits of the bitmap: 64 for each window of the benchmark, within these bounds (2 MB and 16 MB).
MIN_BITS, MAX_BITS = 1 << 24, 1 << 27
_CHUNK_CHARS, _CACHE = 1 << 21, 300_000
#: Words of a document that are kept in one row.
_PIECE = 256

# Words that are units where they follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g gram grams kg kilogram kilograms lb lbs "
    "pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute "
    "minutes h hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros "
    "degree degrees meter meters metre metres kilometer kilometers kilometre kilometres mph kmh".split()
)
# Numbers written as words.
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
# Words that are no names, though they begin sentences.
FUNCTION_WORDS = frozenset(
    "a an the this that these those each every all both some any no none either neither another other such one i you he "
    "she it we they my your his her its our their me him us them who whom whose which what when where why how if then "
    "else than as and or but nor so yet for because since while until unless although though whether after before during "
    "at by from in into of off on onto out over through to toward towards under up upon with within without about above "
    "across against along among around behind below beneath beside between beyond down near per is are was were be been "
    "being am do does did has have had can could would should shall must not there here also only just still even "
    "however therefore thus hence".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
_QUANTITY = re.compile(r"[+-]?\d[\d.,]*[^\W\d_]+")
_EDGE = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
_MONEY_OR_SHARE = re.compile(r"[+-]?[$€£].*|.*%")
_SENTENCE_END = re.compile(r"[.!?:;][\"')\]]*$")
LITERAL, NUMBER, QUANTITY, UNIT, NAME, NOTHING, START = range(7)  # START: a name by the second reading only
PLACEHOLDERS = {NUMBER: "<num>", QUANTITY: "<qty>", UNIT: "<unit>", NAME: "<name>"}


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def _word(raw: str) -> tuple[str, int, int, bool, bool, bool, bool, bool]:
    """Word in lower case, what it may be, hash of the word, whether a sentence ends after it, whether the words
    before and after it may belong to it, whether it is a function word, and an amount of money or a share."""
    if raw.isalpha() and raw.islower() and raw not in NUMBER_WORDS and raw not in UNITS:  # most words: neither sign nor slot
        return raw, LITERAL, xxhash.xxh64_intdigest(raw.encode()), False, True, True, raw in FUNCTION_WORDS, False
    core = _EDGE.sub("", raw)
    low = core.lower()
    if not core:
        kind = NOTHING
    elif _NUMBER.fullmatch(core) or low in NUMBER_WORDS:
        kind = NUMBER
    elif _QUANTITY.fullmatch(core):
        kind = QUANTITY
    elif low in UNITS:
        kind = UNIT
    elif len(core) > 1 and core[0].isupper() and core[1:].islower():
        kind = NAME
    else:
        kind = LITERAL
    return (
        low, kind, _hash(low), bool(_SENTENCE_END.search(raw)), raw.startswith(core), raw.endswith(core),
        low in FUNCTION_WORDS, kind == NUMBER and bool(_MONEY_OR_SHARE.fullmatch(low)),
    )


class Template:
    """Canonical words of many texts at once, as flat arrays; ``owner`` tells the text of each word.

    This is the first reading; ``slots`` gives the second.
    """

    salt = np.uint64(0)

    def __init__(self, texts: list[str | None], cache: dict):
        distinct, parts = Numbering(), [np.zeros(0, np.int64)]
        for text in texts:
            words = text.split() if text else []
            parts.append(np.fromiter(map(distinct.__getitem__, words), np.int64, len(words)))
        codes, owner = np.concatenate(parts), np.repeat(np.arange(len(texts)), [len(p) for p in parts[1:]])
        if len(cache) > _CACHE:
            cache.clear()
        known = []
        for word in distinct:
            found = cache.get(word)
            if found is None:
                found = cache[word] = _word(word)
            known.append(found)
        low, kinds, hashes, *marks = zip(*known) if known else [()] * 8
        kinds, hashes = np.array(kinds, np.int8), np.array(hashes, np.uint64)
        ends, self._opens, self._closes, self._function, self._priced = (np.array(m, bool) for m in marks)
        self.low = list(low)
        first = np.ones(len(codes), bool)
        first[1:] = (owner[1:] != owner[:-1]) | ends[codes[:-1]]
        kind = kinds[codes] if len(codes) else np.zeros(0, np.int8)
        kept = kind != NOTHING
        self.codes, self.owner, kind, first = codes[kept], owner[kept], kind[kept], first[kept]
        follows = np.zeros(len(kind), bool)
        follows[1:] = (kind[:-1] == NUMBER) & (self.owner[1:] == self.owner[:-1])
        kind[(kind == UNIT) & ~follows] = LITERAL
        self._capital, self._first = kind == NAME, first
        kind[(kind == NAME) & first] = LITERAL
        self.kind = kind
        self.own = hashes[self.codes] if len(self.codes) else np.zeros(0, np.uint64)
        self.canonical = np.where(kind == LITERAL, self.own, kind.astype(np.uint64))

    def slots(self) -> Template:
        """The second reading: first words of sentences as names, and one word for each sequence that fills a slot."""
        t = Template.__new__(Template)
        codes, kind = self.codes, self.kind.copy()
        kind[self._capital] = np.where(self._first[self._capital], START, NAME)
        kind[self._capital & self._function[codes]] = LITERAL
        kind[(kind == NUMBER) & self._priced[codes]] = QUANTITY
        joins = np.zeros(len(codes), bool)
        if len(codes):
            beside = (self.owner[1:] == self.owner[:-1]) & self._closes[codes[:-1]] & self._opens[codes[1:]]
            names = ((kind[:-1] == NAME) | (kind[:-1] == START)) & (kind[1:] == NAME)
            joins[1:] = beside & (names | ((kind[:-1] == NUMBER) & (kind[1:] == UNIT)))
        heads = np.nonzero(~joins)[0]
        stops = np.append(heads[1:], len(codes))
        t.low, t.codes, t.kind, t.owner, t.own = list(self.low), codes[heads], kind[heads], self.owner[heads], self.own[heads]
        made: dict[tuple, tuple[int, int]] = {}
        for i in np.nonzero(stops - heads > 1)[0]:
            parts = tuple(codes[heads[i]:stops[i]].tolist())
            t.kind[i] = QUANTITY if kind[heads[i]] == NUMBER else NAME
            if parts not in made:
                word = ("" if t.kind[i] == QUANTITY else " ").join(self.low[c] for c in parts)
                made[parts] = len(t.low), _hash(word)
                t.low.append(word)
            t.codes[i], t.own[i] = made[parts]
        placeholder = np.where(t.kind == START, NAME, t.kind).astype(np.uint64)
        t.canonical = np.where(t.kind == LITERAL, t.own, placeholder)
        t.salt = np.uint64(0x5107_0000_5107_0000)
        return t

    def readings(self) -> tuple[Template, Template]:
        return self, self.slots()

    def windows(self, width: int, least_literals: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, key) of every window of ``width`` words inside one text."""
        n = len(self.codes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.nonzero(self.owner[:n] == self.owner[width - 1:])[0]
        literals = np.concatenate(([0], np.cumsum(self.kind == LITERAL)))
        plain = (literals[width:] - literals[:-width])[at] < min(least_literals, width)
        step = np.uint64(0x9E3779B97F4A7C15)
        keys = np.zeros(n, np.uint64)
        for j in range(width):
            keys = (keys ^ self.canonical[j:j + n]) * step
            keys ^= keys >> np.uint64(29)
        keys, some = keys[at], at[plain]
        own = np.zeros(len(some), np.uint64)
        for j in range(width):
            own = (own ^ self.own[some + j]) * step
            own ^= own >> np.uint64(29)
        keys[plain] = own
        return at, keys ^ np.uint64(width * 2) ^ plain.astype(np.uint64) ^ self.salt

    def words(self, start: int, stop: int) -> list[str]:
        return [self.low[c] for c in self.codes[start:stop]]

    def kinds(self, start: int, stop: int) -> list[int]:
        return self.kind[start:stop].tolist()


def consistent_share(item: list[str], doc: list[str], kinds: list[int]) -> float:
    """Share of the slots that agree with a one-to-one reading of the item's values; 1.0 without slots."""
    seen: dict[tuple, dict[str, int]] = {}
    slots = 0
    for mine, theirs, kind in zip(item, doc, kinds):
        if kind != LITERAL:
            slots += 1
            for side, value, other in (("item", mine, theirs), ("doc", theirs, mine)):
                votes = seen.setdefault((side, kind, value), {})
                votes[other] = votes.get(other, 0) + 1
    if not slots:
        return 1.0
    agreed = {side: sum(max(v.values()) for k, v in seen.items() if k[0] == side) for side in ("item", "doc")}
    return min(agreed.values()) / slots


def slot_kinds(item: list[str], doc: list[str], item_kinds: list[int], doc_kinds: list[int]) -> list[int] | None:
    """The slot that each pair of words fills, or LITERAL; None if a pair does not match.

    A first word of a sentence that stays as it is fills a slot only if its name is changed elsewhere.
    """
    begins = [START in pair for pair in zip(item_kinds, doc_kinds)]
    item_kinds, doc_kinds = ([NAME if k == START else k for k in kinds] for kinds in (item_kinds, doc_kinds))
    if any(a != b and (k != q or k == LITERAL) for a, b, k, q in zip(item, doc, item_kinds, doc_kinds)):
        return None
    changed = {x for a, b, k in zip(item, doc, item_kinds) if k == NAME and a != b for x in (a, b)}
    return [
        LITERAL if k != q or (first and a == b and a not in changed) else k
        for a, b, k, q, first in zip(item, doc, item_kinds, doc_kinds, begins)
    ]


def drift_of(n: int) -> int:
    """By how many words the diagonals of one copy of an item of ``n`` words may differ."""
    return max(WINDOW, n // 8)


def chain(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(item position, document position) of the longest alignment that goes forward in both.

    ``spans`` are (shift, start, stop): item words start..stop match the document words ``shift`` further on.
    """
    spans = sorted(spans, key=lambda x: (x[1], x[2], x[0]))
    shift, start, stop = (np.array(x, np.int64) for x in zip(*spans))
    best, entry, before = np.zeros(len(spans), np.int64), start.copy(), np.full(len(spans), -1)
    for j in range(len(spans)):
        best[j] = stop[j] - start[j]
        if j:
            enter = np.maximum(start[j], np.maximum(stop[:j], stop[:j] + shift[:j] - shift[j]))
            total = np.where(enter < stop[j], best[:j] + stop[j] - enter, 0)
            i = int(total.argmax())
            if total[i] > best[j]:
                best[j], entry[j], before[j] = total[i], enter[i], i
    out, j = [], int(best.argmax())
    while j >= 0:
        out.extend((i, i + int(shift[j])) for i in range(int(stop[j]) - 1, int(entry[j]) - 1, -1))
        j = int(before[j])
    return out[::-1]


def _spans(shift: int, ats: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """The joined windows of one diagonal as spans of item words."""
    ats = np.unique(ats)
    cuts = np.nonzero(np.diff(ats) > width)[0] + 1
    return [(shift, int(part[0]), int(part[-1]) + width) for part in np.split(ats, cuts)]


def _chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    sizes = np.cumsum([len(t) if t else 0 for t in batch["text"]]) // _CHUNK_CHARS
    for _, part in batch.groupby(sizes, sort=False):
        yield part


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, min_literals: int = MIN_LITERALS,
    min_coverage: float = MIN_COVERAGE, min_consistency: float = MIN_CONSISTENCY,
) -> DataFrame:
    """(row_key, id, item_id, coverage, consistency) of documents that hold a benchmark item.

    ``coverage`` is the share of the item's words inside joined windows that follow
    each other in document and item, their diagonals at most ``drift_of`` words
    apart; ``consistency`` the share of its slots filled one to one. An item
    shorter than a window is one window of its own length; an item or document
    without words (null, empty, punctuation only) never matches. ``row_key`` is
    the hash of identifier and text, by which rows without an identifier are told
    apart; rows that repeat both are reported once. Items that repeat an
    identifier are all looked for and the best of them is reported. Empty tables
    give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    row_key = F.xxhash64(F.col(id_col), F.col(text_col))

    def cut_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for batch in batches:
            for i, text in zip(batch["item_key"], batch["text"]):
                for reading, t in enumerate(Template([text], cache).readings()):
                    n = len(t.codes)
                    if n:
                        at, keys = t.windows(min(window, n), min_literals)
                        yield pd.DataFrame({
                            "item_key": [i], "reading": [reading], "n": [n], "words": [t.words(0, n)],
                            "kinds": [t.kinds(0, n)], "keys": [keys.view(np.int64)],
                        })

    keyed = benchmark.select(
        F.col(item_col).alias("item"), F.xxhash64(F.col(item_col), F.col(item_text_col)).alias("item_key"),
        F.col(item_text_col).alias("text"),
    ).dropDuplicates(["item_key"])
    items = stored(
        keyed.select("item_key", "text")
        .mapInPandas(
            cut_items, "item_key long, reading int, n int, words array<string>, kinds array<int>, keys array<long>"
        ),
        "items",
    )
    grams = stored(items.select("item_key", "reading", "n", F.posexplode("keys").alias("at", "key")), "grams")
    widths: list[list[int]] = [[], []]
    for r in items.select("reading", F.least(F.col("n"), F.lit(window)).alias("w")).distinct().collect():
        widths[r["reading"]].append(r["w"])
    bits, number = MIN_BITS, grams.count()
    while bits < min(MAX_BITS, 64 * number):
        bits *= 2
    place = F.pmod("key", F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    set_bits = grams.select(F.floor(place / 64).alias("word"), bit.alias("bit"))
    words = set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    bitmap = spark.sparkContext.broadcast(bitmap)

    def runs_of(t: Template, widths: list[int], present: np.ndarray) -> Iterator[tuple]:
        """(owner, piece, start, words, kinds, ats, keys) of the pieces of every run of windows that may be joined."""
        hit_at, hit_key, hit_end = [], [], []
        for width in widths:
            at, keys = t.windows(width, min_literals)
            spot = keys & np.uint64(bits - 1)
            hit = (present[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
            hit_at.append(at[hit])
            hit_key.append(keys[hit])
            hit_end.append(at[hit] + width)
        if not sum(map(len, hit_at)):
            return
        at, keys, ends = map(np.concatenate, (hit_at, hit_key, hit_end))
        order = np.lexsort((ends, at))
        at, keys, ends = at[order], keys[order], ends[order]
        reach = np.maximum.accumulate(ends)
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] >= reach[:-1]) | (t.owner[at[1:]] != t.owner[at[:-1]])
        bounds = np.append(np.nonzero(fresh)[0], len(at))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            owner, start, stop = t.owner[at[lo]], int(at[lo]), int(ends[lo:hi].max())
            base = int(np.searchsorted(t.owner, owner))
            while start < stop:
                piece = (start - base) // _PIECE
                end = min(stop, base + (piece + 1) * _PIECE)
                i, j = lo + np.searchsorted(at[lo:hi], [start, end])
                yield (
                    owner, piece, start - base, t.words(start, end), t.kinds(start, end),
                    (at[i:j] - base).tolist(), keys[i:j].view(np.int64).tolist(),
                )
                start = end

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, present = {}, bitmap.value
        for batch in batches:
            for part in _chunks(batch):
                row_keys, out = part["row_key"].to_numpy(np.int64), []
                for reading, t in enumerate(Template(part["text"].tolist(), cache).readings()):
                    out.extend((int(row_keys[owner]), reading, *rest) for owner, *rest in runs_of(t, widths[reading], present))
                yield pd.DataFrame(
                    out, columns=["row_key", "reading", "piece", "start", "words", "kinds", "ats", "keys"]
                )

    runs = stored(
        docs.select(row_key.alias("row_key"), F.col(text_col).alias("text")).mapInPandas(
            find,
            "row_key long, reading int, piece long, start long, words array<string>, kinds array<int>, ats array<long>, "
            "keys array<long>",
        ).dropDuplicates(["row_key", "reading", "start"]),
        "runs",
    )
    hits = runs.select("row_key", "reading", F.explode(F.arrays_zip("ats", "keys")).alias("hit")).select(
        "row_key", "reading", F.col("hit.ats").alias("doc_at"), F.col("hit.keys").alias("key")
    )
    # Diagonals that differ by a drift at most share one of the overlapping blocks of two drifts.
    width = F.least(F.col("n"), F.lit(window))
    drift = F.greatest(F.lit(WINDOW), F.floor(F.col("n") / 8)).cast("long")
    block = F.floor(F.col("shift") / drift).cast("long")
    ats = F.flatten("lines.ats")
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct(ats), lambda a: F.sequence(a, a + width - 1)))))
    pair = ["row_key", "reading", "item_key"]
    lined_up = stored(
        hits.join(grams, ["key", "reading"]).groupBy(*pair, "n", (F.col("doc_at") - F.col("at")).alias("shift"))
        .agg(F.collect_set("at").alias("ats"))
        .withColumn("block", F.explode(F.array(block - 1, block)))
        .groupBy(*pair, "n", "block").agg(F.collect_list(F.struct("shift", "ats")).alias("lines"))
        .where(covered / F.col("n") >= min_coverage)
        .withColumn("shifts", F.col("lines.shift")).withColumn("ats", F.col("lines.ats")).drop("lines"),
        "lined_up",
    )
    first = F.array_min("shifts") + F.array_min(F.flatten("ats"))
    last = F.array_max("shifts") + F.array_max(F.flatten("ats")) + width - 1
    piece = F.explode(F.sequence(F.floor(F.greatest(first, F.lit(0)) / _PIECE), F.floor(last / _PIECE))).alias("piece")
    texts = (
        lined_up.select(*pair, "block", piece)
        .join(runs.select("row_key", "reading", "piece", "start", "words", "kinds"), ["row_key", "reading", "piece"])
        .groupBy(*pair, "block").agg(F.collect_list(F.struct("start", "words", "kinds")).alias("pieces"))
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                drift, lines, best = drift_of(r.n), sorted(zip(r.shifts, r.ats), key=lambda x: x[0]), (0.0, 0.0)
                spans = [_spans(int(shift), np.asarray(ats), min(window, r.n)) for shift, ats in lines]
                words = {p["start"] + j: w for p in r.pieces for j, w in enumerate(zip(p["words"], p["kinds"]))}
                for first, (lowest, _) in enumerate(lines):
                    if lowest >= (r.block + 1) * drift:
                        break  # the next block begins with it
                    near = [x for (shift, _), part in zip(lines[first:], spans[first:]) if shift <= lowest + drift for x in part]
                    inside = np.zeros(r.n, bool)
                    for _, start, stop in near:
                        inside[start:stop] = True
                    if inside.sum() / r.n < max(min_coverage, best[0]) or best[0] == 1.0 == best[1]:
                        continue
                    pairs = chain(near)
                    if len(pairs) / r.n < min_coverage:
                        continue
                    mine, mine_kind = [r.item_words[i] for i, _ in pairs], [r.item_kinds[i] for i, _ in pairs]
                    theirs, their_kind = zip(*[words[k] for _, k in pairs])
                    kinds = slot_kinds(mine, theirs, mine_kind, their_kind)
                    share = 0.0 if kinds is None else consistent_share(mine, theirs, kinds)
                    if kinds is not None and share >= min_consistency:
                        best = max(best, (len(pairs) / r.n, share))
                if best[0]:
                    out.append((r.row_key, r.item_key, *best))
            yield pd.DataFrame(out, columns=["row_key", "item_key", "coverage", "consistency"])

    verified = (
        lined_up.join(texts, [*pair, "block"])
        .join(
            items.select("item_key", "reading", F.col("words").alias("item_words"), F.col("kinds").alias("item_kinds")),
            ["item_key", "reading"],
        )
        .mapInPandas(verify, "row_key long, item_key long, coverage double, consistency double")
    )
    found = stored(verified, "verified").join(keyed.select("item_key", "item"), "item_key")
    best = found.groupBy("row_key", "item").agg(
        F.max(F.struct("coverage", "consistency")).alias("best")
    ).select("row_key", F.col("item").alias(item_col), "best.*")
    ids = docs.select(row_key.alias("row_key"), F.col(id_col).alias(id_col))
    return stored(best, "best").join(ids, "row_key").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns as they were. See ``contaminated``."""
    key = fresh("row_key", docs.columns)
    bad = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(F.col("row_key").alias(key))
    bad = stored(bad.distinct(), "contaminated")
    return docs.join(bad, F.xxhash64(F.col(id_col), F.col(text_col)) == F.col(key), "left_anti")
