"""Periodic runs: stretches of words that repeat with a fixed period.

Maximal-pair enumeration. Two places of a text that share exactly their next l words,
with different words before and after them, are a maximal pair. If their distance p
is at most l, the words from the first place to the end of the second copy have period
p and cannot be extended; so the pairs with p <= l and p + l >= ``min_length`` are the
runs, each with its period and the multiples of it, of which the least is kept.

The suffixes of each text are sorted by prefix doubling, their common prefixes form the
intervals of a tree, and the tree is walked from its leaves. Every interval holds its
places in order, and per word on the left its own list of them: two children meet by
looking up, for each place of the smaller one, the places of the larger one within l
words, either all of them or list by list for other left words, whichever are fewer.
Intervals of fewer than ``min_length / 2`` words cannot hold a run, so only places whose
next words of that number occur twice in the text enter the tree.

Texts are independent: the work is one pass without a shuffle. A task holds a block of
whole texts of about ``BLOCK_WORDS`` words, or one longer text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import Numbering

BLOCK_WORDS = 1 << 19
#: Up to so many places are put into a sorted list one by one; more are appended and sorted.
_FEW = 16

Run = tuple[int, int, int]  # start, length, period


# ---- suffixes --------------------------------------------------------------

def _mixed(symbols: np.ndarray, texts: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the next ``width`` symbols of every place, apart for every text."""
    x = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    n = max(0, len(x) - width + 1)
    mixed = np.zeros(n, np.uint64)
    for j in range(width):
        mixed = mixed * np.uint64(0x94D049BB133111EB) + x[j:j + n]
    return mixed ^ ((texts[:n].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _repeating_texts(symbols: np.ndarray, texts: np.ndarray, width: int) -> np.ndarray:
    """Texts in which ``width`` words may occur twice: all that do, and hardly others."""
    mixed = _mixed(symbols, texts, width)
    order = np.argsort(mixed)
    same = mixed[order[1:]] == mixed[order[:-1]]
    return np.unique(texts[order[1:][same]])


def sorted_suffixes(symbols: np.ndarray, width: int) -> np.ndarray:
    """Places whose next ``width`` symbols occur elsewhere too, in the order of their suffixes.

    The last symbol, and every symbol that ends a text, occurs once.
    """
    m = len(symbols)
    rank, k = symbols.astype(np.int64), 1
    while k < width:  # ranks of the next k symbols
        step = min(k, width - k)
        after = np.zeros(m, np.int64)
        after[:m - step] = rank[step:] + 1
        rank, k = np.unique(rank * (m + 2) + after, return_inverse=True)[1], k + step
    order = np.argsort(rank, kind="stable")
    starts = np.flatnonzero(np.r_[True, rank[order[1:]] != rank[order[:-1]]])
    sizes = np.diff(np.r_[starts, m])
    rank[order] = np.repeat(starts, sizes)  # from here on: where the group of equal prefixes starts
    open_at = at = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    while len(at):
        places = order[at]
        key = rank[places] * (m + 1) + rank[places + k]
        by_key = np.argsort(key, kind="stable")
        places, key = places[by_key], key[by_key]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(at)])
        order[at] = places
        rank[places] = np.repeat(at[starts], sizes)
        at, k = at[np.repeat(sizes, sizes) > 1], 2 * k
    return order[open_at]


def common_prefixes(symbols: Sequence[int], suffixes: Sequence[int], width: int) -> list[int]:
    """Common prefix of each suffix with the one before it in sorted order; the first has none.

    ``suffixes`` are all that share at least ``width`` symbols with another one. A suffix
    that shares more leaves the one after it at most one symbol less, as both neighbours
    are followed by listed ones.
    """
    found = [0] * len(suffixes)
    place = {at: i for i, at in enumerate(suffixes)}
    shared, last = 0, -2
    for at in sorted(suffixes):
        i = place[at]
        shared = shared - 1 if at == last + 1 and shared > width else 0
        last = at
        if not i:
            shared = 0
            continue
        other = suffixes[i - 1]
        while symbols[at + shared] == symbols[other + shared]:
            shared += 1
        found[i] = shared
    return found


# ---- the tree of common prefixes -------------------------------------------

def maximal_pair_runs(symbols: Sequence[int], suffixes: Sequence[int], prefixes: Sequence[int], min_length: int) -> dict:
    """Period by (start, end) of every run among the places of ``suffixes``."""
    least, runs = (min_length + 1) // 2, {}

    def pair(i: int, j: int, shared: int) -> None:
        if i > j:
            i, j = j, i
        period = j - i
        if period + shared >= min_length:
            run = i, j + shared
            if runs.get(run, period) >= period:
                runs[run] = period

    def joined(one: tuple, other: tuple, shared: int) -> tuple:
        """The places of two children of an interval of ``shared`` words, after pairing them."""
        if len(one[0]) < len(other[0]):
            one, other = other, one
        places, by_left = one
        for i in other[0]:
            low, high = bisect_left(places, i - shared), bisect_right(places, i + shared)
            if low == high:
                continue
            mine = symbols[i - 1]
            if high - low <= len(by_left):
                for j in places[low:high]:
                    if symbols[j - 1] != mine:
                        pair(i, j, shared)
            else:
                for word, own in by_left.items():
                    if word != mine:
                        for j in own[bisect_left(own, i - shared):bisect_right(own, i + shared)]:
                            pair(i, j, shared)
        _into(places, other[0])
        for word, own in other[1].items():
            if word in by_left:
                _into(by_left[word], own)
            else:
                by_left[word] = own
        return one

    open_intervals: list[list] = []  # [words shared, children so far], each deeper than the one before
    for i, at in enumerate(suffixes):
        child = [at], {symbols[at - 1]: [at]}
        shared = prefixes[i + 1] if i + 1 < len(suffixes) else 0
        while open_intervals and open_intervals[-1][0] > shared:
            depth, earlier = open_intervals.pop()
            child = joined(earlier, child, depth)
        if shared >= least:
            if open_intervals and open_intervals[-1][0] == shared:
                open_intervals[-1][1] = joined(open_intervals[-1][1], child, shared)
            else:
                open_intervals.append([shared, child])
    return runs


def _into(places: list[int], more: list[int]) -> None:
    if len(more) <= _FEW:
        for at in more:
            insort(places, at)
    else:
        places.extend(more)
        places.sort()


# ---- texts -----------------------------------------------------------------

def runs_of_texts(texts: Sequence[Sequence], min_length: int = 12) -> list[list[Run]]:
    """The runs of each text, given as words, by start and period."""
    least = (min_length + 1) // 2
    found: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    number = Numbering()
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum())
    # Every text is led by a symbol of its own, which also ends the one before; one more ends the last.
    starts = np.r_[0, np.cumsum(sizes + 1)]
    symbols = np.empty(starts[-1] + 1, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[starts] = False
    symbols[inside] = words
    symbols[starts] = len(number) + np.arange(len(starts))
    owners = np.r_[np.repeat(np.arange(len(texts)), sizes + 1), len(texts)]
    chosen = np.isin(owners, _repeating_texts(symbols, owners, least))
    if not chosen.any():
        return found
    symbols, owners = symbols[chosen], owners[chosen]
    heads = np.r_[0, np.flatnonzero(owners[1:] != owners[:-1]) + 1]
    # Symbols apart for every text, so that no suffix meets one of another text, and one more at the end.
    symbols = np.unique(owners * (symbols.max() + 1) + symbols, return_inverse=True)[1]
    symbols = np.r_[symbols, symbols.max() + 1]
    suffixes = sorted_suffixes(symbols, least).tolist()
    plain = symbols.tolist()
    runs = maximal_pair_runs(plain, suffixes, common_prefixes(plain, suffixes, least), min_length)
    for (start, end), period in sorted(runs.items()):
        head = int(np.searchsorted(heads, start, side="right")) - 1
        found[owners[heads[head]]].append((start - int(heads[head]) - 1, end - start, period))
    for own in found:
        own.sort(key=lambda run: (run[0], run[2]))
    return found


def collapsed(words: Sequence, runs: Sequence[Run]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return list(words)
    kept, end = [], 0
    for start, stop in sorted((s + q, s + n) for s, n, q in runs):
        kept.extend(words[end:start])
        end = max(end, stop)
    kept.extend(words[end:])
    return kept


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    ``runs`` lists (start, length, period) by start, then period: the stretches of
    words, numbered from 0, with smallest period ``period`` and at least
    ``max(min_length, 2 * period)`` words that no neighbouring word extends.
    ``collapsed`` joins by one blank the words that no run holds after its first
    period. Words are what ASCII white space separates.

    A null or empty text has no words and no runs. Rows are independent: rows
    without an identifier, repeated rows and equal texts are treated each by itself.
    An empty table gives an empty result, other columns are ignored.
    """
    if min_length < 2:
        raise ValueError("a run has at least two words")

    def found_in(texts: list[list[bytes]], ids: list) -> pd.DataFrame:
        runs = runs_of_texts(texts, min_length)
        return pd.DataFrame({
            "id": pd.Series(ids, dtype=object), "n_words": [len(t) for t in texts],
            **{name: [[run[i] for run in own] for own in runs] for i, name in enumerate(("starts", "lengths", "periods"))},
            "collapsed": [b" ".join(collapsed(t, own)).decode() for t, own in zip(texts, runs)],
        })

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, ids, held = [], [], 0
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                words = (text or b"").split()
                if held and held + len(words) > BLOCK_WORDS:
                    yield found_in(texts, ids)
                    texts, ids, held = [], [], 0
                texts.append(words)
                ids.append(key)
                held += len(words) + 1
        if texts:
            yield found_in(texts, ids)

    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # As text, identifiers pass pandas unchanged, nulls among them or not.
    found = own.select(F.col("id").cast("string"), F.col("text").cast("binary")).mapInPandas(
        find, "id string, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"
    )
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select(F.col("id").cast(own.schema["id"].dataType).alias(id_col), "n_words", runs.alias("runs"), "collapsed")
