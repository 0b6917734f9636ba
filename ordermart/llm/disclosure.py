"""Personal data, and the words that would still give it away.

Addresses, numbers and the like are found by their form. Information-theoretic
sanitisation then asks which words reveal a protected entity: the corpus is cut into
segments of up to ``SEGMENT`` words of a line, and from the numbers of segments with an
entity c, with a term t, with both, and of all, come the information of the entity,
IC(c) = -log2 p(c), and what the term tells of it, PMI(c; t) = log2 p(c | t) / p(c). A
term that tells at least the share ``share`` of that information, and ``bits`` bits, in
``support`` different wordings or more, discloses the entity. In every text that holds
the entity such a term is generalised to its class (number, name, word), or removed
where the class would disclose the entity too.

Copies of a text are one wording: the word before and the word after a term must
differ. Entities that a large share of the segments hold have little information and
are disclosed by nothing.

All counts cover the whole corpus. The texts are read twice, to find the entities with
the terms beside them, and to count the terms that can disclose one at all: by its
segments beside entities alone, a term cannot be rarer than that. These, and at the end
the disclosing pairs, are looked up in a bitmap of at most 16 MB and then joined
exactly. What is shuffled are counts, and spans by text.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.bitmaps import bitmap, holds
from ordermart.llm.common import Numbering, stored

BASE = ("email", "ip", "card", "phone")
#: Generalised and removed terms; spans are listed by kind in this order.
KINDS = (*BASE, "term", "removed")
SEGMENT, SHARE, BITS, SUPPORT = 32, 0.8, 6.0, 2
CLASSES = ("number", "name", "word")
_CLASS_TERMS = tuple(f"\0{name}" for name in CLASSES)  # no term holds a zero character
_SEGMENTS = "\0"
_VOCABULARY = 1 << 19  # spellings a task remembers at a time

Span = tuple[int, int, int]  # kind, start, end


# ---- entities by their form ------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match starts with its first run of digits, so the places inside a run need no trial.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The signs before an @ belong to one name: it starts as far left as it can."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of all entities by kind and start, in code points, the end exclusive."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append((1, *m.span()))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((3, *m.span()))
    return found


def entity(kind: int, written: str) -> str:
    """The same for all ways of writing an entity."""
    if BASE[kind] in ("card", "phone"):
        written = re.sub("[^0-9]", "", written)
    return f"{BASE[kind]}:{written.lower()}"


# ---- terms and segments ----------------------------------------------------

_TOKEN = re.compile(r"[^\W_]+|\n")


def term_class(token: str) -> int:
    """Place in CLASSES: with a digit, with a capital first, or neither."""
    return 0 if any(c.isdigit() for c in token) else 1 if token[:1].isupper() else 2


def _segments(ends: np.ndarray) -> np.ndarray:
    """Segment of every token, given which of them end a line."""
    n = len(ends)
    line = np.cumsum(ends) - ends
    first = np.r_[0, np.flatnonzero(ends) + 1]
    return line * (n + 1) + (np.arange(n) - first[line]) // SEGMENT


def beside_entities(text: str, spans: list[Span]) -> tuple[list[str], list[tuple]]:
    """Entities by segment, and (entity, term, wording, new with the entity, new in the segment) of the terms there.

    ``new ...`` is 1 for the first place of an entity and term, or of a term, in a segment.
    Classes are listed as terms of their own.
    """
    tokens = [m for m in _TOKEN.finditer(text)]
    words = [m.group().lower() for m in tokens]
    segment = _segments(np.array([w == "\n" for w in words], bool)).tolist()
    starts = np.array([m.start() for m in tokens])
    held: dict[int, set[str]] = {}
    masked = set()
    for kind, start, end in spans:
        low, high = np.searchsorted(starts, [start, end])
        if low and tokens[low - 1].end() > start:
            low -= 1
        masked.update(range(low, high))
        if low < high:
            held.setdefault(segment[low], set()).add(entity(kind, text[start:end]))
    entities = [c for cs in held.values() for c in sorted(cs)]
    pairs, met = [], set()
    for i, word in enumerate(words):
        cs = held.get(segment[i])
        if not cs or i in masked or word == "\n":
            continue
        around = zlib.crc32(" ".join(words[max(0, i - 1):i + 2]).encode())
        for term, wording in (word, around), (_CLASS_TERMS[term_class(tokens[i].group())], 0):
            once = (segment[i], term) not in met
            met.add((segment[i], term))
            for c in cs:
                first = (segment[i], c, term) not in met
                met.add((segment[i], c, term))
                if first or wording:
                    pairs.append((c, term, wording, int(first), int(once)))
                    once = False
    return entities, pairs


class Counted:
    """Numbers of segments with each term that a bitmap lets through, with each class, and of all."""

    def __init__(self, wanted: np.ndarray) -> None:
        self.wanted, self.counts = wanted, Counter()
        self._forget()

    def _forget(self) -> None:
        self.spellings, self.terms = Numbering(), Numbering()
        self.term_of, self.class_of = np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self) -> None:
        """Look up the spellings met since the last time; -1 for the term of one that is not wanted."""
        terms, classes = [], []
        for token in list(self.spellings)[len(self.term_of):]:
            low = token.lower()
            wanted = token != "\n" and holds(self.wanted, xxhash.xxh64_intdigest(low.encode(), 42))
            terms.append(self.terms[low] if wanted else -1)
            classes.append(term_class(token))
        self.term_of = np.r_[self.term_of, np.array(terms, np.int64)]
        self.class_of = np.r_[self.class_of, np.array(classes, np.int64)]

    def add(self, texts: list[str]) -> None:
        spelled: list[int] = []
        line_end = self.spellings["\n"]
        for text in texts:
            spelled.extend(map(self.spellings.__getitem__, _TOKEN.findall(text)))
            spelled.append(line_end)
        token = np.array(spelled, np.int64)
        self._learn()
        segment, inside = _segments(token == line_end), token != line_end
        token, segment = token[inside], segment[inside]
        segment = np.unique(segment, return_inverse=True)[1]
        number = int(segment.max()) + 1 if len(segment) else 0
        self.counts[_SEGMENTS] += number
        in_class = np.unique(self.class_of[token] * max(1, number) + segment) // max(1, number)
        for name, n in zip(_CLASS_TERMS, np.bincount(in_class, minlength=len(CLASSES)).tolist()):
            self.counts[name] += n
        term = self.term_of[token]
        term, segment = term[term >= 0], segment[term >= 0]
        by_term = np.unique(term * max(1, number) + segment) // max(1, number)
        which, n = np.unique(by_term, return_counts=True)
        names = list(self.terms)
        for i, m in zip(which.tolist(), n.tolist()):
            self.counts[names[i]] += m
        if len(self.spellings) > _VOCABULARY:
            self._forget()


def _told(both: Column, term: Column, entity: Column, total: Column) -> tuple[Column, Column]:
    """(bits that the term tells of the entity, information of the entity), from numbers of segments."""
    return F.log2(both / term * total / entity), F.log2(total / entity)


# ---- the corpus ------------------------------------------------------------

def _tallies(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Segments of each entity and term with the wordings of the term, of each entity, and of each term beside any."""
    pairs = found.select(F.explode(F.arrays_zip("c", "t", "wording", "first", "once")).alias("p")).select("p.*")
    worded = pairs.groupBy("c", "t", "wording").agg(F.sum("first").alias("n"))
    both = worded.groupBy("c", "t").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("wordings"))
    entities = found.select(F.explode("entities").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n_entity"))
    beside = pairs.groupBy("t").agg(F.sum("once").alias("n_beside"))
    return both, entities, beside


def disclosing_terms(
    docs: DataFrame, found: DataFrame, share: float = SHARE, bits: float = BITS, support: int = SUPPORT
) -> DataFrame:
    """(c, t, told, information, class_number, class_name, class_word) of the disclosing pairs.

    ``docs`` has a ``text``, ``found`` what ``_find`` gives for the same rows. The last three
    columns say whether the class discloses the entity as well.
    """
    both, entities, beside = (stored(f, n) for f, n in zip(_tallies(found), ("pairs", "entities", "beside")))
    # No more segments than signs and rows: a bound that lets every disclosing pair through.
    most = docs.select(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1)).first()[0] or 1

    def discloses(told: Column, information: Column) -> Column:
        return (told >= share * information) & (told >= bits)

    paired = both.join(entities, "c")
    terms = paired.where(~F.col("t").startswith(_SEGMENTS) & (F.col("wordings") >= support)).join(beside, "t")
    likely = stored(
        terms.where(discloses(*_told(F.col("n_both"), F.col("n_beside"), F.col("n_entity"), F.lit(float(most)))))
        .select("c", "t", "n_both", "n_entity"), "likely",
    )
    wanted = bitmap(likely.select("t").distinct(), F.xxhash64("t"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counted(wanted.value)
        for batch in batches:
            texts, size = [], 0
            for text in batch["text"]:
                if text:
                    texts.append(text)
                    size += len(text)
                    if size > 1 << 22:
                        seen.add(texts)
                        texts, size = [], 0
            seen.add(texts)
            if len(seen.counts) > _VOCABULARY:
                yield pd.DataFrame({"t": list(seen.counts), "n": list(seen.counts.values())})
                seen.counts.clear()
        if seen.counts:
            yield pd.DataFrame({"t": list(seen.counts), "n": list(seen.counts.values())})

    counts = stored(
        docs.select("text").mapInPandas(count, "t string, n long").groupBy("t").agg(F.sum("n").alias("n_term")), "term_counts"
    )
    whole = {r["t"]: r["n_term"] for r in counts.where(F.col("t").startswith(_SEGMENTS)).collect()}  # four rows
    total = F.lit(float(whole.get(_SEGMENTS, 1) or 1))
    told, information = _told(F.col("n_both"), F.col("n_term"), F.col("n_entity"), total)
    flagged = (
        likely.join(counts, "t").withColumns({"told": told, "information": information})
        .where(discloses(F.col("told"), F.col("information")))
    )
    by_class = [
        F.coalesce(F.max(F.when(
            F.col("t") == name,
            discloses(*_told(F.col("n_both"), F.lit(float(whole.get(name, 0) or 1)), F.col("n_entity"), total)),
        )), F.lit(False)).alias(f"class_{CLASSES[i]}")
        for i, name in enumerate(_CLASS_TERMS)
    ]
    classes = paired.where(F.col("t").startswith(_SEGMENTS)).groupBy("c").agg(*by_class)
    return stored(flagged.join(classes, "c").select("c", "t", "told", "information", *[f"class_{n}" for n in CLASSES]), "disclosing")


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Base spans of every row; for rows with any also the text, the entities and the terms beside them."""
    for batch in batches:
        rows = []
        for key, text in zip(batch["id"], batch["text"]):
            spans = base_spans(text or "")
            if not spans:
                rows.append((key, None, *[[]] * 9))
                continue
            entities, pairs = beside_entities(text, spans)
            rows.append((key, text, *map(list, zip(*spans)), entities, *(map(list, zip(*pairs)) if pairs else [[]] * 5)))
        yield pd.DataFrame(rows, columns=["id", "text", "kinds", "starts", "ends", "entities", "c", "t", "wording", "first", "once"])


_FOUND = (
    "id string, text string, kinds array<int>, starts array<long>, ends array<long>, entities array<string>, "
    "c array<string>, t array<string>, wording array<long>, first array<int>, once array<int>"
)


def _term_spans(found: DataFrame, flagged: DataFrame) -> DataFrame:
    """(key, terms): spans of the disclosing terms of every text that holds their entity; key is the text's digest."""
    terms = bitmap(flagged.select("t").distinct(), F.xxhash64("t"))
    pairs = bitmap(flagged, F.xxhash64("c", "t"))

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, starts, ends, entities in zip(*(batch[c] for c in ("key", "text", "starts", "ends", "entities"))):
                places: dict[str, list] = {}
                for m in _TOKEN.finditer(text):
                    places.setdefault(m.group().lower(), []).append(m)
                order = np.argsort(starts, kind="stable")
                firsts, reach = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
                hashes = {c: xxhash.xxh64_intdigest(c.encode(), 42) for c in set(entities)}
                for term, met in places.items():
                    word = term.encode()
                    if term == "\n" or not holds(terms.value, xxhash.xxh64_intdigest(word, 42)):
                        continue
                    free = []  # places outside all base spans
                    for m in met:
                        before = int(np.searchsorted(firsts, m.end())) - 1
                        if before < 0 or reach[before] <= m.start():
                            free.append((m.start(), m.end(), term_class(m.group())))
                    if not free:
                        continue
                    at = [list(x) for x in zip(*free)]
                    rows += [(key, c, term, *at) for c, h in hashes.items() if holds(pairs.value, xxhash.xxh64_intdigest(word, h))]
            if rows:
                yield pd.DataFrame(rows, columns=["key", "c", "t", "starts", "ends", "classes"])

    schema = "key string, c string, t string, starts array<long>, ends array<long>, classes array<int>"
    near = found.select("key", "text", "starts", "ends", "entities").mapInPandas(locate, schema).join(flagged, ["c", "t"])
    spans = near.select(
        "key", F.array(*[f"class_{n}" for n in CLASSES]).alias("open"), F.explode(F.arrays_zip("starts", "ends", "classes")).alias("s")
    )
    gone = F.when(F.get("open", F.col("s.classes")), KINDS.index("removed")).otherwise(KINDS.index("term"))
    each = spans.groupBy("key", F.col("s.starts").alias("start"), F.col("s.ends").alias("end")).agg(F.max(gone).alias("kind"))
    return each.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("terms"))


def _with_spans(docs: DataFrame, **options) -> DataFrame:
    """(id as text, key, spans) of every row of (id, text); the key is null, and spans are empty, where nothing is found."""
    found = stored(docs.select(F.col("id").cast("string"), "text").mapInPandas(_find, _FOUND), "found", compression="zstd")
    flagged = disclosing_terms(docs, found, **options)
    found = found.withColumn("key", F.md5("text"))
    terms = stored(_term_spans(found.where("key is not null"), flagged), "term_spans")
    base = F.transform(
        F.arrays_zip("kinds", "starts", "ends"),
        lambda s: F.struct(s["kinds"].alias("kind"), s["starts"].alias("start"), s["ends"].alias("end")),
    )
    base = found.select("id", "key", base.alias("base"))
    some = base.where("key is not null").join(terms, "key", "left")
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.concat("base", "terms"))
    return some.select("id", "key", spans.alias("spans")).unionByName(
        base.where("key is null").select("id", "key", F.col("base").alias("spans"))
    )


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(spans, lambda s: F.struct(
        F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
    ))


def personal_data(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, bits: float = BITS,
    support: int = SUPPORT,
) -> DataFrame:
    """(id, spans) of every row: what to hide in its text.

    ``spans`` lists (kind, start, end) by kind in the order of ``KINDS``, then start, in
    code points, the end exclusive: entities by their form (email, ip, card, phone), and
    outside of them the disclosing terms to be generalised (term) or removed (removed).

    Null text counts as empty and has no spans. Rows without an identifier and repeated
    rows are treated as any other; equal texts get equal spans. An empty table gives an
    empty result; other columns are ignored.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = _with_spans(own, share=share, bits=bits, support=support)
    return found.select(F.col("id").cast(own.schema["id"].dataType).alias(id_col), _named(F.col("spans")).alias("spans"))


def sanitised(text: str, kinds: list[int], starts: list[int], ends: list[int], labels: tuple[str, ...]) -> str:
    """The text with its spans replaced; of overlapping spans the longer reach counts, under the first label."""
    out, at = [], 0
    for start, end, kind in sorted(zip(starts, ends, kinds)):
        if start >= at:
            out += [text[at:start], labels[kind] if kind != KINDS.index("term") else f"[{CLASSES[term_class(text[start:end])]}]"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def sanitise(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with entities and disclosing terms replaced in their texts; all columns stay.

    Entities become [email], [ip], [card] or [phone], generalised terms [number], [name]
    or [word]; removed terms leave nothing. Texts without a span, null ones included,
    stay as they are.
    """
    own = docs.select(F.lit(None).cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    spans = _with_spans(own, **options).where("key is not null").groupBy("key").agg(F.first("spans").alias("spans"))
    spans = stored(spans, "spans")
    labels = (*[f"[{k}]" for k in BASE], "", "")

    @F.pandas_udf("string")
    def replaced(text: pd.Series, kinds: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        rows = zip(text, kinds, starts, ends)
        return pd.Series([None if t is None else sanitised(t, k, a, b, labels) for t, k, a, b in rows], dtype=object)

    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    joined = joined.join(spans, F.md5("text") == F.col("key"), "left")
    fields = [F.col(f"spans.{f}") for f in ("kind", "start", "end")]  # an array of each
    # Only texts with spans pass through Python.
    new = F.coalesce(replaced(F.when(F.col("key").isNotNull(), F.col("text")), *fields), F.col("text"))
    done = joined.select("row", new.alias("new"))
    return done.select(*[F.col("new").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
