"""Induced suffix sorting with common prefixes, for one shard of text.

The suffixes of type LMS (leftmost in a rising run) are ordered first: they are
cut into LMS substrings, which an induced sort orders and names, and the reduced
string of names is ordered by doubling, no further than ``limit`` characters.
From them all suffixes that fall and then all that rise are induced: whoever
takes suffix i off a queue puts suffix i - 1 onto the queue of its character, so
each queue fills in sorted order. A queue entry carries the suffix and the
length of the prefix it shares with the entry before it, which is one more than
the least such length between the two suffixes they come from.

Queues live on disk beyond a budget, so only the text and one number for each LMS
suffix have to fit into memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

_CHUNK = 1 << 18


class SuffixQueue:
    """Priority queue of (suffix, shared prefix): by character, then by arrival.

    Chunks beyond ``budget`` entries are kept in an unnamed file of this task,
    which vanishes with it.
    """

    def __init__(self, budget: int):
        self.budget, self.held, self.file, self.chunks = budget, 0, None, {}

    def push(self, char: int, suffixes: np.ndarray, shared: np.ndarray | None) -> None:
        if self.held + len(suffixes) <= self.budget:
            self.held += len(suffixes)
            chunk = (suffixes, shared)
        else:
            self.file = self.file or tempfile.TemporaryFile()
            start = self.file.seek(0, 2)
            suffixes.tofile(self.file)
            if shared is not None:
                shared.tofile(self.file)
            chunk = (start, len(suffixes), shared is not None)
        self.chunks.setdefault(char, []).append(chunk)

    def spans(self, char: int, first: int = 0) -> list[tuple[int, int]]:
        """Numbers (from, to) of the chunks that have arrived since ``first``, put together to a fair size."""
        out, start, size = [], first, 0
        for number in range(first, self.count(char)):
            length = self._length(char, number)
            if size and size + length > _CHUNK:
                out.append((start, number))
                start, size = number, 0
            size += length
        return out + [(start, self.count(char))] if size else out

    def _length(self, char: int, number: int) -> int:
        chunk = self.chunks[char][number]
        return len(chunk[0]) if len(chunk) == 2 else chunk[1]

    def get(self, char: int, span: tuple[int, int]) -> tuple[np.ndarray, np.ndarray | None]:
        """The entries of the chunks of a span."""
        found = [self._read(self.chunks[char][number]) for number in range(*span)]
        if len(found) == 1:
            return found[0]
        suffixes = np.concatenate([x[0] for x in found])
        return suffixes, None if found[0][1] is None else np.concatenate([x[1] for x in found])

    def _read(self, chunk: tuple) -> tuple[np.ndarray, np.ndarray | None]:
        if len(chunk) == 2:
            return chunk
        start, length, with_shared = chunk
        self.file.seek(start)
        suffixes = np.frombuffer(self.file.read(4 * length), np.int32)
        return suffixes, np.frombuffer(self.file.read(2 * length), np.int16) if with_shared else None

    def count(self, char: int) -> int:
        return len(self.chunks.get(char, ()))


class SuffixSorter:
    """Sorts the suffixes of ``text`` (uint16, ends with its only 0) up to ``limit`` characters."""

    def __init__(self, text: np.ndarray, limit: int, budget: int = 1 << 25):
        self.text, self.limit, self.budget, n = text, limit, budget, len(text)
        step = np.sign(np.diff(text.astype(np.int32))).astype(np.int8)
        turn = np.nonzero(step)[0]
        following = np.searchsorted(turn, np.arange(n - 1))
        self.run = np.append(np.minimum(turn[following] - np.arange(n - 1) + 1, limit), 1).astype(np.int16)
        self.rising = np.append(step[turn[following]] > 0, True)
        self.lms = np.nonzero(self.rising[1:] & ~self.rising[:-1])[0].astype(np.int32) + 1
        self.alphabet = int(text.max()) + 1

    # -- induction -------------------------------------------------------------

    def _induce(self, queue: SuffixQueue, target: np.ndarray, suffixes, shared, pending) -> None:
        """Push the predecessors of type ``target`` of a chunk that is next in order."""
        at = np.nonzero((suffixes > 0) & target[suffixes - 1])[0]
        before = suffixes[at] - 1
        chars = self.text[before]
        order = np.argsort(chars, kind="stable")
        chars, at, before = chars[order], at[order], before[order]
        cuts = np.append(np.nonzero(np.diff(chars, prepend=-1))[0], len(chars))
        open_before = None
        if shared is not None and len(shared):
            open_before = pending.copy()
            np.minimum(pending, shared.min(), out=pending)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            char, values = int(chars[lo]), None
            if shared is not None:
                e = at[lo:hi]
                values = np.minimum.reduceat(shared[:e[-1] + 1], np.concatenate(([0], e[:-1] + 1)))
                values[0] = min(values[0], open_before[char])
                values = np.minimum(values + 1, self.limit).astype(np.int16)
                if not queue.count(char):
                    values[0] = 0
                rest = shared[e[-1] + 1:]
                pending[char] = rest.min() if len(rest) else self.limit
            queue.push(char, before[lo:hi], values)

    def _pending(self) -> np.ndarray:
        return np.full(self.alphabet, self.limit, np.int16)

    def _fall(self, lms: np.ndarray, shared: np.ndarray | None) -> SuffixQueue:
        """Falling suffixes by character, induced from ordered LMS suffixes."""
        queue, pending, falling = SuffixQueue(self.budget), self._pending(), ~self.rising
        firsts = np.searchsorted(self.text[lms], np.arange(self.alphabet + 1))
        for char in range(self.alphabet):
            number, last = 0, None
            while spans := queue.spans(char, number):  # runs of a character push onto their own queue
                for span in spans:
                    chunk = queue.get(char, span)
                    self._induce(queue, falling, *chunk, pending)
                    number, last = span[1], chunk[0][-1]
            for lo in range(firsts[char], firsts[char + 1], _CHUNK):
                part = lms[lo:min(lo + _CHUNK, firsts[char + 1])]
                own = None
                if shared is not None:
                    own = shared[lo:lo + len(part)].copy()
                    if lo == firsts[char]:
                        own[0] = 0 if last is None else min(self.run[last], self.run[part[0]])
                self._induce(queue, falling, part, own, pending)
        return queue

    def _rise(self, fallen: SuffixQueue, with_shared: bool) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """All suffixes but the last, largest first, with the prefix each shares with the one before."""
        queue, pending = SuffixQueue(self.budget), self._pending()
        for char in range(self.alphabet - 1, -1, -1):
            number, last = 0, None
            while spans := queue.spans(char, number):
                for span in spans:
                    chunk = queue.get(char, span)
                    yield chunk
                    self._induce(queue, self.rising, *chunk, pending)
                    number, last = span[1], chunk[0][-1]
            carried = None
            for span in reversed(fallen.spans(char)):
                suffixes, shared = fallen.get(char, span)
                suffixes, own = suffixes[::-1], None
                if with_shared:
                    if carried is None:
                        carried = 0 if last is None else min(self.run[last], self.run[suffixes[0]])
                    own = np.concatenate(([carried], shared[:0:-1])).astype(np.int16)
                    carried = shared[0]
                yield suffixes, own
                self._induce(queue, self.rising, suffixes, own, pending)

    # -- LMS suffixes ----------------------------------------------------------

    def _names(self) -> np.ndarray:
        """Names of the LMS substrings in text order; equal substrings have equal names."""
        lms, is_lms = self.lms, np.zeros(len(self.text), bool)
        is_lms[lms] = True
        fallen = self._fall(lms[np.argsort(self.text[lms], kind="stable")], None)
        found = [s[is_lms[s]] for s, _ in self._rise(fallen, False)]
        ordered = np.concatenate([*found, lms[-1:]])[::-1]  # the end of the text is the least suffix
        place = np.zeros(len(self.text), np.int32)
        place[lms] = np.arange(len(lms), dtype=np.int32)
        length = np.append(np.diff(lms) + 1, 1)[place[ordered]]
        differs = np.ones(len(ordered), bool)
        same = np.nonzero(length[1:] == length[:-1])[0] + 1
        offset = 0
        left, right, size = ordered[same], ordered[same - 1], length[same]
        while len(same):
            done = size <= offset
            differs[same[done]] = False
            go = ~done
            same, left, right, size = same[go], left[go], right[go], size[go]
            equal = self.text[left + offset] == self.text[right + offset]
            same, left, right, size = same[equal], left[equal], right[equal], size[equal]
            offset += 1
        names = np.zeros(len(lms), np.int64)
        names[place[ordered]] = np.cumsum(differs) - 1
        return names

    def _ordered_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS suffixes in order, and the prefix each shares with the one before it."""
        lms, m = self.lms, len(self.lms)
        levels, ranks, width = [], self._names(), 1
        order = np.argsort(ranks, kind="stable")
        beyond = np.append(lms.astype(np.int64), np.full(m, len(self.text) + self.limit))
        while True:
            levels.append((width, ranks))
            sorted_ranks = ranks[order]
            tied = np.zeros(m, bool)
            tied[1:] = sorted_ranks[1:] == sorted_ranks[:-1]
            tied[:-1] |= tied[1:]
            ties = order[tied]
            if not len(ties) or (beyond[np.minimum(ties + width, 2 * m - 1)] - lms[ties]).min() >= self.limit:
                break
            later = np.append(ranks + 1, np.zeros(width, np.int64))[width:]
            key = ranks * (m + 1) + later
            order[tied] = ties[np.argsort(key[ties])]  # only ties move, each inside its own range
            sorted_key = key[order]
            ranks = np.zeros(m, np.int64)
            ranks[order] = np.cumsum(np.diff(sorted_key, prepend=sorted_key[0]) != 0)
            width *= 2
        a, b = order[1:].copy(), order[:-1].copy()
        padded = [(w, np.append(r, -1)) for w, r in levels]
        for w, r in reversed(padded):
            equal = r[np.minimum(a, m)] == r[np.minimum(b, m)]
            equal &= (a < m) & (b < m)
            a[equal] += w
            b[equal] += w
        ends = np.append(lms, len(self.text)).astype(np.int64)
        reach = ends[np.minimum(a, m)] - lms[order[1:]]
        x, y = lms[order[1:]] + reach, lms[order[:-1]] + reach
        shared, open_ones = np.minimum(reach, self.limit), np.nonzero(reach < self.limit)[0]
        while len(open_ones):
            i, j = x[open_ones], y[open_ones]
            inside = (i < len(self.text)) & (j < len(self.text))
            equal = inside.copy()
            equal[inside] = self.text[i[inside]] == self.text[j[inside]]
            open_ones = open_ones[equal]
            shared[open_ones] += 1
            x[open_ones] += 1
            y[open_ones] += 1
            open_ones = open_ones[shared[open_ones] < self.limit]
        return lms[order], np.concatenate(([0], shared)).astype(np.int16)

    def descending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks of (suffixes, shared): all suffixes but the last from the largest down.

        ``shared`` is the length, up to ``limit``, of the prefix that a suffix
        shares with the one before it in this order. Suffixes that agree in
        ``limit`` characters come in any order.
        """
        fallen = self._fall(*self._ordered_lms())
        yield from self._rise(fallen, True)


def repeated_starts(parts: list[bytes], length: int, budget: int = 1 << 25) -> list[np.ndarray]:
    """For each part the starts whose ``length`` bytes also start elsewhere in the parts."""
    sizes = np.array([len(p) for p in parts], np.int64)
    offsets = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int(sizes.sum()) + len(parts) + 1, np.uint16)  # 1 ends a part, 0 the text
    text[-1] = 0
    for at, part in zip(offsets, parts):
        text[at:at + len(part)] = np.frombuffer(part, np.uint8).astype(np.uint16) + 2
    marks, last = np.zeros(len(text), bool), None
    for suffixes, shared in SuffixSorter(text, length, budget).descending():
        hit = np.nonzero(shared >= length)[0]
        marks[suffixes[hit]] = True
        marks[suffixes[hit[hit > 0] - 1]] = True
        if len(hit) and hit[0] == 0:
            marks[last] = True
        last = suffixes[-1]
    return [np.nonzero(marks[at:at + max(0, size - length + 1)])[0] for at, size in zip(offsets, sizes)]
