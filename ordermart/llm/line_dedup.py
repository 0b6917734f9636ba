"""Line dedup: fuzzy lines by MinHash.

Lines are compared in normal form (lower case, white space collapsed). Repeated
lines are brought together by their keys, each with its count and its first place;
texts stay where they were cut but for those of candidates. A line that a chunk of
documents shows for the first time is cut into character shingles and gets a MinHash
signature (one permutation hashing, densified); ``bands`` groups of ``rows`` values
are its bands, and lines that share a band are candidates. Verification computes the
exact Jaccard similarity of the shingle sets:

1. every member of a band bucket is verified against the least line of the
   bucket, and the links found are joined to components (distributed union-find);
2. buckets of three or more that still hold several components are compared line
   by line inside tasks; only links that join components leave the task, and the
   components are joined again.

In both steps shared shingle hashes are counted for many pairs at once, and pairs
that reach the bound within two shingles are settled on the shingles themselves.

So a large group of near copies costs one pair per member and bucket, pairs are
never listed, and still no link between candidates is lost. A bucket of more than
``BLOCK`` lines is compared in blocks, each pair of blocks by a group of its own.
Of each component the first line in the order (id, position) stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import fresh, passing_tables, stored
from ordermart.llm.components import connected_components

SHINGLE, BANDS, ROWS, SIMILARITY = 8, 16, 5, 0.8
#: Lines that are compared with each other in one block, and lines and shingles that a task holds at a time.
BLOCK, _TASK_LINES, _COLUMNS = 2048, 20_000, 4096
#: Buckets up to this size are compared pair by pair, larger ones as matrices.
_SMALL = 48
#: Characters that are hashed or signed, and shingles that are compared, at a time.
_CHUNK_CHARS, _SIGN_CHARS, _CHUNK_SHINGLES = 1 << 19, 1 << 17, 1 << 20
#: Bands that a bucket of them is planned for, and that are dealt to buckets at a time.
_BUCKET_BANDS, _DEALT_BANDS = 1 << 18, 1 << 21
#: Bits of a shingle's hash beside the number of its line or pair.
_HASH_BITS = np.uint64(40)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def normal_line(line: str) -> str:
    return " ".join(line.lower().split())


def normal_lines(text: str) -> list[str]:
    """``normal_line`` of every line; most texts have no white space but single blanks inside lines."""
    low = text.lower()
    loose = "  " in low or " \n" in low or "\n " in low or low.startswith(" ") or low.endswith(" ")
    if not loose and low.replace("\n", "").isprintable():  # no white space but the blank is printable
        return low.split("\n")
    return [" ".join(line.split()) for line in low.split("\n")]


# ---- signatures ------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    part = x >> np.uint64(30)
    x = x ^ part
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=part)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=part)
    return x


@lru_cache(maxsize=8)
def _fallbacks(bins: int) -> np.ndarray:
    """For every bin an order in which the other bins are asked while it is empty."""
    draw = np.random.default_rng(17)
    return np.stack([draw.permutation(bins) for _ in range(bins)])


def _window_hashes(lines: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Length of every line, a shingle at least, and the hash at every character of the joined lines.

    The last ``shingle - 1`` hashes of a line run into the next one.
    """
    lengths = np.fromiter((len(x) for x in lines), np.int64, len(lines))
    padded = np.maximum(lengths, shingle)
    codes = np.frombuffer(
        "".join(x if len(x) >= shingle else x.ljust(shingle, "\0") for x in lines).encode("utf-32-le", "surrogatepass"),
        np.uint32,
    ).astype(np.uint64)
    codes += np.uint64(1)
    hashes, width = _mix(codes), 1
    parts, offset, rest = [], 0, shingle
    while rest:  # a polynomial over the shingle, by doubling
        if rest & 1:
            parts.append((offset, hashes))
            offset += width
        rest >>= 1
        if rest:
            doubled = hashes[:-width] * _mix(np.array([width + 7], np.uint64))
            doubled += hashes[width:]
            hashes = doubled
            width *= 2
    whole = np.zeros(max(0, len(codes) - shingle + 1), np.uint64)
    for at, part in parts:
        whole *= _MULTIPLIER
        whole += part[at:at + len(whole)]
    return padded, _mix(whole)


def shingle_hashes(lines: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of every shingle; a line shorter than a shingle is one shingle."""
    padded, whole = _window_hashes(lines, shingle)
    counts = padded - shingle + 1
    line = np.repeat(np.arange(len(lines)), counts)
    shift = (np.cumsum(padded) - padded) - (np.cumsum(counts) - counts)
    return line, whole[np.arange(len(line)) + np.repeat(shift, counts)]


def band_keys(lines: list[str], bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> np.ndarray:
    """Array (line, band) of 64-bit keys."""
    bins = bands * rows
    padded, value = _window_hashes(lines, shingle)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    signature = np.full(len(lines) * bins, empty)
    mixed = _mix(value)
    across = (np.cumsum(padded)[:-1, None] - np.arange(1, shingle)).ravel()
    mixed[across] = empty  # of no line, and never less than what is there
    value >>= np.uint64(32)
    value *= np.uint64(bins)
    value >>= np.uint64(32)
    value += np.repeat(np.arange(len(lines), dtype=np.uint64) * np.uint64(bins), padded)[:len(value)]
    np.minimum.at(signature, value.view(np.int64), mixed)
    signature = signature.reshape(len(lines), bins)
    own, order = signature.copy(), _fallbacks(bins)
    row, column = np.nonzero(own == empty)
    for attempt in range(bins):
        if not len(row):
            break
        source = order[column, attempt]
        found = own[row, source]
        signature[row, column] = found + np.array([attempt + 1], np.uint64) * _MULTIPLIER
        left = found == empty
        row, column = row[left], column[left]
    keys = np.tile(_mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(lines), 1))
    for r in range(rows):
        keys = _mix(keys * _MULTIPLIER + signature.reshape(len(lines), bands, rows)[:, :, r])
    return keys.view(np.int64)


@lru_cache(maxsize=512)  # the least line of a bucket meets all others of it
def _shingles(line: str, shingle: int) -> frozenset[str]:
    return frozenset(line[i:i + shingle] for i in range(max(1, len(line) - shingle + 1)))


@lru_cache(maxsize=512)
def _packed_shingles(line: str, shingle: int) -> np.ndarray | None:
    """The shingles as sorted numbers, none twice, if each fits into eight bytes; None if not or if the line is shorter than one."""
    if shingle > 8 or len(line) < shingle:
        return None
    try:
        codes = line.encode("latin-1") + bytes(8)
    except UnicodeEncodeError:
        return None
    # Eight bytes from every character on, of which those behind the shingle are shifted out.
    packed = np.ndarray(len(line) - shingle + 1, "<u8", codes, strides=(1,)) << np.uint64(64 - 8 * shingle)
    packed.sort()
    return packed[np.append(True, packed[1:] != packed[:-1])]


def similar(x: str, y: str, least: float = SIMILARITY, shingle: int = SHINGLE) -> bool:
    """Exact Jaccard similarity of the character shingles, compared with ``least``."""
    a, b = _packed_shingles(x, shingle), _packed_shingles(y, shingle)
    if a is None or b is None:
        a, b = _shingles(x, shingle), _shingles(y, shingle)
        shared = len(a & b)
    elif min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    else:
        both = np.concatenate((a, b))
        both.sort()
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared >= least * (len(a) + len(b) - shared)


def _chunks(sizes: np.ndarray, most: int) -> list[slice]:
    """Cuts a sequence into runs whose sizes add up to about ``most``; every run has one member at least."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    return [slice(a, b) for a, b in zip([0, *cuts], [*cuts, len(sizes)]) if a < b]


class _ShingleSets:
    """The sets of shingle hashes of lines, one after another in ``values``."""

    def __init__(self, lines: list[str], shingle: int):
        parts = []
        for part in _chunks(np.fromiter((len(x) + shingle for x in lines), np.int64, len(lines)), _CHUNK_CHARS):
            line, hashes = shingle_hashes(lines[part], shingle)
            keyed = np.sort(((line + part.start).astype(np.uint64) << _HASH_BITS) | (hashes >> (np.uint64(64) - _HASH_BITS)))
            parts.append(keyed[np.append(True, keyed[1:] != keyed[:-1])])
        keyed = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.values = keyed & ((np.uint64(1) << _HASH_BITS) - np.uint64(1))
        self.sizes = np.bincount((keyed >> _HASH_BITS).astype(np.int64), minlength=len(lines))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``chosen``, value) of the chosen lines' shingles."""
        sizes = self.sizes[chosen]
        number = np.repeat(np.arange(len(chosen)), sizes)
        shift = self.starts[chosen] - (np.cumsum(sizes) - sizes)
        return number.astype(np.uint64), self.values[np.arange(len(number)) + np.repeat(shift, sizes)]

    def near(self, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
        """Which pairs of lines may reach ``least``; two shingles more are granted for colliding hashes."""
        a, b = self.sizes[x], self.sizes[y]
        passed = np.minimum(a, b) + 2 >= least * np.maximum(a, b) - 1e-9
        at = np.flatnonzero(passed)
        for part in _chunks((a + b)[at], _CHUNK_SHINGLES):
            some = at[part]
            keyed = np.concatenate([(n << _HASH_BITS) | v for n, v in (self._of(x[some]), self._of(y[some]))])
            keyed.sort()
            shared = np.bincount((keyed[1:][keyed[1:] == keyed[:-1]] >> _HASH_BITS).astype(np.int64), minlength=len(some)) + 2
            passed[some] = shared >= least * (a[some] + b[some] - shared) - 1e-9
        return passed


def joining_links(
    lines: list[str], groups: np.ndarray, least: float = SIMILARITY, shingle: int = SHINGLE
) -> list[tuple[int, int]]:
    """Pairs of similar lines that connect the groups just as all similar pairs would."""
    line, hashes = shingle_hashes(lines, shingle)
    number = np.unique(hashes, return_inverse=True)[1]
    number, line = np.divmod(np.unique(number * len(lines) + line), max(1, len(lines)))  # once in a line, by shingle
    sizes = np.bincount(line, minlength=len(lines)).astype(np.float32)
    several = np.bincount(number) > 1  # a shingle of one line only is in no intersection
    shared = several[number]
    line, columns = line[shared], (np.cumsum(several) - 1)[number[shared]]
    both = np.zeros((len(lines), len(lines)), np.float32)
    for lo in range(0, int(columns[-1]) + 1 if len(columns) else 0, _COLUMNS):
        a, b = np.searchsorted(columns, (lo, lo + _COLUMNS))
        matrix = np.zeros((len(lines), _COLUMNS), np.float32)
        matrix[line[a:b], columns[a:b] - lo] = 1
        both += matrix @ matrix.T
    near = np.argwhere(np.triu(both >= least * (sizes[:, None] + sizes[None, :] - both) - 1e-3, 1))
    return _joined(near, lines, groups, least, shingle)


def _joined(near: np.ndarray, lines: list[str], groups: np.ndarray, least: float, shingle: int) -> list[tuple[int, int]]:
    """Of the pairs, the rows of ``near``, those that are similar and join groups that earlier ones have not joined."""
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    links, near = [], near[groups[near[:, 0]] != groups[near[:, 1]]]
    for (x, y), a, b in zip(near.tolist(), groups[near[:, 0]].tolist(), groups[near[:, 1]].tolist()):
        a, b = root(a), root(b)
        if a != b and similar(lines[x], lines[y], least, shingle):
            parent[max(a, b)] = min(a, b)
            links.append((x, y))
    return links


def small_bucket_links(
    lines: list[str], groups: np.ndarray, buckets: list[tuple[np.ndarray, int]], least: float = SIMILARITY,
    shingle: int = SHINGLE,
) -> list[tuple[int, int]]:
    """As ``joining_links``, within many small buckets at once.

    A bucket is the numbers of its lines and how many at its start are settled
    with all others already.
    """
    pairs = [np.stack(np.triu_indices(len(of) - done, 1)) + done for of, done in buckets]
    pairs = [of[pair] for (of, _), pair in zip(buckets, pairs)]
    if not pairs:
        return []
    pairs = np.concatenate(pairs, axis=1)
    pairs = pairs[:, groups[pairs[0]] != groups[pairs[1]]]
    pairs = np.stack(np.divmod(np.unique(pairs[0] * len(lines) + pairs[1]), len(lines)))
    near = pairs[:, _ShingleSets(lines, shingle).near(pairs[0], pairs[1], least)]
    return _joined(near.T, lines, groups, least, shingle)


# ---- the operator ----------------------------------------------------------

def _verified(pairs: DataFrame, texts: DataFrame, least: float, shingle: int) -> DataFrame:
    """Of the pairs (a, b) of line keys those that are similar."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _chunks((batch["ta"].str.len() + batch["tb"].str.len()).to_numpy(np.int64), _CHUNK_SHINGLES):
                some = batch.iloc[part]
                left, right = some["ta"].tolist(), some["tb"].tolist()
                plain = [x.isascii() and y.isascii() for x, y in zip(left, right)]
                passed = np.fromiter((not p or similar(x, y, least, shingle) for p, x, y in zip(plain, left, right)), bool, len(some))
                rest = np.flatnonzero(~np.array(plain, bool))
                if len(rest):
                    numbers, lines = pd.factorize(np.array([*(left[at] for at in rest), *(right[at] for at in rest)], object))
                    near = _ShingleSets(lines.tolist(), shingle).near(numbers[:len(rest)], numbers[len(rest):], least)
                    passed[rest] = [n and similar(left[at], right[at], least, shingle) for n, at in zip(near, rest)]
                yield some.loc[passed, ["a", "b"]]

    left = texts.select(F.col("k").alias("a"), F.col("line").alias("ta"))
    right = texts.select(F.col("k").alias("b"), F.col("line").alias("tb"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(check, "a long, b long")


def cut_lines(docs: DataFrame) -> DataFrame:
    """(id, row_key, ats, ks, lines): the lines of every document that are not blank.

    Positions, keys and normal forms run along each other; the normal form is null
    where the same chunk of documents has shown it before.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for span in _chunks(np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts)), 4 * _CHUNK_CHARS):
                shown, ends, ats, ks, lines = {}, [0], [], [], []
                for t in texts[span]:
                    for at, line in enumerate(normal_lines(t) if t else ()):
                        if not line:
                            continue
                        key = shown.get(line)
                        lines.append(line if key is None else None)
                        if key is None:
                            key = shown[line] = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 42)
                        ats.append(at)
                        ks.append(key)
                    ends.append(len(ats))
                columns = pa.array(ats, pa.int32()), pa.array(np.array(ks, np.uint64).view(np.int64)), pa.array(lines, pa.string())
                part = batch.slice(span.start, span.stop - span.start)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row_key"), *[pa.ListArray.from_arrays(pa.array(ends, pa.int32()), c) for c in columns]],
                    ["id", "row_key", "ats", "ks", "lines"],
                )

    return docs.mapInArrow(cut, "id string, row_key long, ats array<int>, ks array<long>, lines array<string>")


def shared_bands(cut: DataFrame, number: int, *, shingle: int, bands: int, rows: int) -> DataFrame:
    """(band, k, leader, n): the keys of the lines of every band that several of them have, the least of them as leader.

    ``cut`` is as ``cut_lines`` returns it, with about ``number`` distinct lines. The bands
    of many lines travel as one row per bucket; a line that several chunks show is one.
    """
    buckets = max(1, -(-number * bands // _BUCKET_BANDS))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column("lines").flatten(), batch.column("ks").flatten()
            shown = texts.is_valid()
            texts, keys = texts.filter(shown).to_pylist(), keys.filter(shown).to_numpy()
            for span in _chunks(np.full(len(texts), bands), _DEALT_BANDS):
                lines = texts[span]
                sizes = np.fromiter((len(x) + shingle for x in lines), np.int64, len(lines))
                band = np.concatenate([band_keys(lines[part], bands, rows, shingle) for part in _chunks(sizes, _SIGN_CHARS)]).ravel()
                bucket = (band.view(np.uint64) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
                order = np.argsort(bucket, kind="stable")
                band, k, bucket = band[order], np.repeat(keys[span], bands)[order], bucket[order]
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                parts = [slice(x, y) for x, y in zip(first, [*first[1:], len(bucket)])]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket[first].astype(np.int64)),
                    "bands": [band[part].tobytes() for part in parts], "ks": [k[part].tobytes() for part in parts],
                })

    def gather(bucket: pd.DataFrame) -> pd.DataFrame:
        band, k = (np.frombuffer(b"".join(bucket[x]), np.int64) for x in ("bands", "ks"))
        order = np.argsort(band)
        band, k = band[order], k[order]
        again = band[1:] == band[:-1]
        several = np.append(again, False) | np.append(False, again)
        band, k = band[several], k[several]
        order = np.lexsort((k, band))
        band, k = band[order], k[order]
        fresh = np.append(True, (band[1:] != band[:-1]) | (k[1:] != k[:-1]))[:len(band)]
        band, k = band[fresh], k[fresh]
        first = np.flatnonzero(np.append(True, band[1:] != band[:-1])[:len(band)])
        n = np.diff(np.append(first, len(band)))
        out = pd.DataFrame({"band": band, "k": k, "leader": np.repeat(k[first], n), "n": np.repeat(n, n)})
        return out[out["n"] > 1]

    return (
        cut.select("lines", "ks").mapInArrow(sign, "bucket long, bands binary, ks binary")
        .groupBy("bucket").applyInPandas(gather, "band long, k long, leader long, n long")
    )


def line_components(
    cut: DataFrame, number: int, *, shingle: int, bands: int, rows: int, similarity: float
) -> DataFrame:
    """(node, component) of the keys of lines that have a similar other line; ``cut`` as stored, with ``number`` distinct lines."""
    members = stored(shared_bands(cut, number, shingle=shingle, bands=bands, rows=rows), "members")
    pairs = stored(members.where("k != leader").select(F.col("leader").alias("a"), F.col("k").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("k")).union(pairs.select("b")).distinct()
    shown = cut.select(F.explode(F.arrays_zip("ks", "lines")).alias("l")).where("l.lines is not null")
    shown = shown.select(F.col("l.ks").alias("k"), F.col("l.lines").alias("line"))
    texts = stored(shown.join(wanted, "k").groupBy("k").agg(F.min("line").alias("line")), "texts", compression="zstd")
    links = stored(_verified(pairs, texts, similarity, shingle), "links")
    found = stored(connected_components(links), "components")

    of = found.select(F.col("node").alias("k"), "component")
    apart = stored(
        members.where("n > 2").join(of, "k", "left").select("band", "leader", "k", F.coalesce("component", "k").alias("component")), "placed"
    )
    unclear = apart.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("k")).alias("mark"), F.bit_xor(F.xxhash64("k", F.lit(1))).alias("second"),
    ).where("low < high")
    # Bands often gather the same lines: one bucket of equal members is compared.
    unclear = unclear.groupBy("n", "mark", "second").agg(F.min("band").alias("band"))
    unclear = stored(unclear.select("band", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")), "unclear")
    rows = apart.join(unclear, "band").withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = stored(rows.select(
        F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"), "k", "component",
        (F.col("k") == F.col("leader")).alias("settled"),
    ).distinct(), "unclear_rows")
    tasks = F.lit(max(1, -(-rows.count() // _TASK_LINES)))

    def compare(task: pd.DataFrame) -> pd.DataFrame:
        out, small = [], []
        task = task.sort_values(["bucket", "settled"], ascending=[True, False], ignore_index=True)
        numbers, keys = pd.factorize(task["k"])
        at = pd.Series(np.arange(len(task))).groupby(numbers).first().to_numpy()
        lines, groups = task["line"].to_numpy()[at].tolist(), task["component"].to_numpy(np.int64)[at]
        for _, part in task.groupby("bucket", sort=False):
            of = numbers[part.index]
            if len(of) <= _SMALL:
                small.append((of, int(part["settled"].sum())))
            else:
                out += [(of[x], of[y]) for x, y in joining_links([lines[n] for n in of], groups[of], similarity, shingle)]
        out += small_bucket_links(lines, groups, small, similarity, shingle)
        return pd.DataFrame([(keys[x], keys[y]) for x, y in out], columns=["a", "b"], dtype="int64")

    more = stored(
        rows.join(texts, "k").groupBy(F.pmod(F.xxhash64("bucket"), tasks).alias("task"))
        .applyInPandas(compare, "a long, b long").distinct(),
        "more",
    )
    if more.isEmpty():
        return found
    return connected_components(links.unionByName(more))


def line_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bands: int = BANDS,
    rows: int = ROWS, similarity: float = SIMILARITY,
) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text column; all rows and columns stay.

    A line goes if an earlier line, of the same or of another document, is equal
    or linked to it. Lines end at line feeds; blank lines are never removed and
    the other lines keep their spelling and order. A line shorter than a shingle
    is one shingle, so it is only like lines of equal normal form.

    "Earlier" is by identifier, then by the text's hash, then by position; rows
    without an identifier come first. Rows that repeat identifier and text are
    one document: each keeps the same lines. Null text stays null, empty text
    stays empty, a text whose lines all go becomes empty. An empty table gives an
    empty table. Two distinct lines are taken for equal if their 64-bit keys
    agree, which at 10^9 lines has odds of about 3 in 100.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    row_key = F.xxhash64(key, text)
    source = docs.select(key.cast("string").alias("id"), row_key.alias("row_key"), text.alias("text"))
    with passing_tables(docs.sparkSession):
        cut = stored(cut_lines(source), "lines", compression="zstd")
        places = cut.select(
            F.col("id").cast(kind).alias("id"), "row_key", F.explode(F.arrays_zip("ats", "ks")).alias("l")
        ).select("id", "row_key", F.col("l.ats").alias("at"), F.col("l.ks").alias("k"))
        place = F.struct("id", "row_key", "at")
        distinct = stored(places.groupBy("k").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "distinct_lines")
        found = line_components(cut, distinct.count(), shingle=shingle, bands=bands, rows=rows, similarity=similarity)
        components = stored(found, "line_components")
        firsts = (
            distinct.join(components.withColumnRenamed("node", "k"), "k", "left")
            .where("n > 1 or component is not null").withColumn("component", F.coalesce("component", "k"))
        )
        firsts = stored(firsts, "firsts")
        kept = stored(firsts.groupBy("component").agg(F.min("first").alias("kept")), "kept")
        repeated = stored(firsts.join(kept, "component").select("k", "kept"), "repeated")
        gone = stored(
            places.join(repeated, "k").where(~place.eqNullSafe(F.col("kept")))
            .groupBy("row_key").agg(F.collect_set("at").alias("gone")),
            "gone", lasting=True,
        )
    row, taken = fresh("row_key", docs.columns), fresh("gone", docs.columns)
    stay = F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains(taken, i)), "\n")
    return (
        docs.withColumn(row, row_key)
        .join(gone.select(F.col("row_key").alias(row), F.col("gone").alias(taken)), row, "left")
        .withColumn(text_col, F.when(F.col(taken).isNull(), text).otherwise(stay))
        .select(*[f"`{n}`" for n in docs.columns])
    )
