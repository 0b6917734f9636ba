"""Language-model scoring with a hidden Markov model.

Texts are cut into lower-cased words and a closing mark. Latent states emit word
classes, words being dealt to ``classes`` classes by hash; a class emits its words
by their training counts, with one count for the words it has never seen. So the
vocabulary may be of any size while what the states learn has a fixed one.

* Documents are packed once into blocks (one row each, bounded by characters)
  that hold their tokens as numbers into the block's own vocabulary.
* Word counts over all training documents are summed from the blocks, and every
  block gets the counts of its own words by a join; no task sees the vocabulary.
* Baum-Welch: each partition of blocks sums expected transitions and emissions,
  Spark adds them up, and the driver divides (states x classes numbers).
* Scoring is the scaled forward recursion. Long texts are cut into segments whose
  transition products are chained, which is exact and keeps the vectors long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import LOWER, UPPER, Numbering, stored

STATES, CLASSES, ITERATIONS = 4, 4096, 4
#: Characters of text after which a block is closed; a longer text is a block of its own.
BLOCK_CHARS = 1 << 21
_SEGMENT, _RESCALE, _PRIOR, _JOINED = 256, 8, 0.5, 400_000
_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BLOCK = (
    "block long, ids array<string>, held_out array<boolean>, sizes array<int>, words array<string>, "
    "trained array<long>, classes binary, tokens binary"
)


# ---- blocks ----------------------------------------------------------------

def _pack(block: int, ids: list, held: list, texts: list, classes: int) -> pd.DataFrame:
    """One row of ``_BLOCK``; token 0 is the closing mark, token i the word i - 1.

    The words' classes are kept beside them, so only the counts by word ask for the words again.
    """
    numbers = Numbering({b" ": 0})  # no word holds a blank
    number, parts = numbers.__getitem__, []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_ASCII_LOWER).split()
        words.append(b" ")
        parts.append(np.fromiter(map(number, words), np.uint32, len(words)))
    sizes, tokens = [len(p) for p in parts], np.concatenate(parts)
    train = np.repeat(~np.array(held, bool), sizes)
    trained = np.bincount(tokens[train], minlength=len(numbers))
    words = [w.decode("utf-8", "surrogatepass") for w in numbers][1:]
    own = np.fromiter((class_of(w, classes) for w in words), np.uint32, len(words))
    narrow = tokens.astype(np.uint16) if len(numbers) <= 1 << 16 else tokens
    return pd.DataFrame({
        "block": [block], "ids": [ids], "held_out": [held], "sizes": [sizes], "words": [words],
        "trained": [trained.tolist()], "classes": [own.tobytes()], "tokens": [narrow.tobytes()],
    })


def pack_blocks(docs: DataFrame, block_chars: int, classes: int) -> DataFrame:
    """Blocks of (id as text, held_out, text) rows."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, chars = TaskContext.get().partitionId() << 32, 0
        ids, held, texts = [], [], []
        for batch in batches:
            for i, h, t in zip(batch["id"], batch["held_out"], batch["text"]):
                size = len(t) if t else 0
                if ids and chars + size > block_chars:
                    yield _pack(block, ids, held, texts, classes)
                    block, chars, ids, held, texts = block + 1, 0, [], [], []
                ids.append(i)
                held.append(bool(h))
                texts.append(t)
                chars += size + 1
        if ids:
            yield _pack(block, ids, held, texts, classes)

    return docs.mapInPandas(pack, _BLOCK)


def class_of(word: str, classes: int) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) % classes


def _tokens(row) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a block, and the classes of its words."""
    own = np.frombuffer(row.classes, np.uint32)
    kind = np.uint16 if len(own) + 1 <= 1 << 16 else np.uint32
    return np.frombuffer(row.tokens, kind).astype(np.int64), own.astype(np.int64)


def _classes(row, classes: int) -> np.ndarray:
    """Class of every token of a block; the closing mark is the class after the last."""
    tokens, own = _tokens(row)
    return np.concatenate(([classes], own))[tokens]


# ---- recursions ------------------------------------------------------------

class Sequences:
    """Class sequences cut into segments of at most ``_SEGMENT``, longest segments first."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, segment: int = _SEGMENT):
        sizes = np.asarray(sizes, np.int64)
        parts = -(-sizes // segment)
        self.doc = np.repeat(np.arange(len(sizes)), parts)
        self.part = np.arange(len(self.doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(np.cumsum(sizes) - sizes, parts) + self.part * segment
        lengths = np.minimum(np.repeat(sizes, parts) - self.part * segment, segment)
        order = np.argsort(-lengths, kind="stable")
        self.doc, self.part, self.lengths, self.starts = self.doc[order], self.part[order], lengths[order], starts[order]
        self.symbols, self.docs, self.parts = symbols, len(sizes), parts
        self.steps = int(self.lengths[0]) if len(self.lengths) else 0
        #: Segments that still run at each step.
        self.active = len(self.lengths) - np.searchsorted(self.lengths[::-1], np.arange(self.steps), side="right")
        #: Segments of each rank inside their document, in the order of documents.
        self.by_part = [np.nonzero(self.part == p)[0] for p in range(int(parts.max()) if len(parts) else 0)]

    def at(self, step: int) -> np.ndarray:
        return self.symbols[self.starts[:self.active[step]] + step]


class Hmm:
    """Start, transition and emission probabilities; ``emit`` is (states, symbols).

    States are the first axis of all arrays, so that each operation runs along
    many sequences at once.
    """

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, np.ascontiguousarray(emit)

    def _products(self, s: Sequences) -> tuple[np.ndarray, np.ndarray]:
        """Scaled products of move x emission over each segment of a text of several, and logs of the scales.

        (from, to, segment). The first step of a document has no move; there the
        product starts at the emission.
        """
        k, rows = len(self.start), np.nonzero(s.parts[s.doc] > 1)[0]
        product, scale = np.tile(np.eye(k)[:, :, None], (1, 1, len(rows))), np.zeros(len(rows))
        opening, starts = s.part[rows] == 0, s.starts[rows]
        active = np.searchsorted(rows, s.active)
        for step in range(s.steps):
            m = int(active[step])
            if not m:
                break
            now = product[:, :, :m]
            moved = np.matmul(self.move.T, now)
            if step == 0:
                moved = np.where(opening[:m], now, moved)
            moved *= np.take(self.emit, s.symbols[starts[:m] + step], axis=1)
            if step % _RESCALE == _RESCALE - 1:
                size = moved.max(axis=(0, 1))
                moved /= size
                scale[:m] += np.log(size)
            product[:, :, :m] = moved
        whole, scales = np.zeros((k, k, len(s.doc))), np.zeros(len(s.doc))
        whole[:, :, rows], scales[rows] = product, scale
        return whole, scales

    def _entries(self, s: Sequences) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State distribution before every segment, products, and logs of the likelihood up to there."""
        product, scale = self._products(s)
        before, reached = np.zeros((len(self.start), len(s.doc))), np.zeros(len(s.doc))
        now, log = np.tile(self.start[:, None], (1, s.docs)), np.zeros(s.docs)
        for rows in s.by_part:
            docs = s.doc[rows]
            before[:, rows], reached[rows] = now[:, docs], log[docs]
            more = s.part[rows] + 1 < s.parts[docs]
            rows, docs = rows[more], docs[more]
            after = np.einsum("in,ijn->jn", now[:, docs], product[:, :, rows])
            size = after.sum(axis=0)
            now[:, docs] = after / size
            log[docs] += np.log(size) + scale[rows]
        return before, product, reached

    def _forward(self, s: Sequences, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Symbols, state distributions after them, and the scale taken out, step by step."""
        opening, now = s.part == 0, before
        for step in range(s.steps):
            m = s.active[step]
            moved = self.move.T @ now[:, :m]
            if step == 0:
                moved = np.where(opening[:m], now[:, :m], moved)
            symbol = s.at(step)
            moved *= np.take(self.emit, symbol, axis=1)
            size = moved.sum(axis=0)
            moved /= size
            yield symbol, moved, size
            now = moved

    def log_likelihood(self, s: Sequences) -> np.ndarray:
        """Natural log of the likelihood of every document."""
        before, _, log = self._entries(s)
        for _, _, size in self._forward(s, before):
            log[:len(size)] += np.log(size)
        last = s.part + 1 == s.parts[s.doc]
        found = np.zeros(s.docs)
        found[s.doc[last]] = log[last]
        return found

    def expected(self, s: Sequences) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, transitions and emissions (states, symbols) by forward and backward recursion."""
        k = len(self.start)
        starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros_like(self.emit)
        if not s.steps:
            return starts, moves, emits
        before, product, _ = self._entries(s)
        behind, later = np.ones((k, len(s.doc))), np.ones((k, s.docs))
        for rows in reversed(s.by_part):
            docs = s.doc[rows]
            behind[:, rows] = later[:, docs]
            more = s.part[rows] > 0
            rows, docs = rows[more], docs[more]
            ahead = np.einsum("ijn,jn->in", product[:, :, rows], later[:, docs])
            later[:, docs] = ahead / ahead.sum(axis=0)

        steps, opening = list(self._forward(s, before)), s.part == 0
        weights = []
        for step in range(s.steps - 1, -1, -1):
            symbol, after, _ = steps[step]
            m = len(symbol)
            gamma = after * behind[:, :m]
            gamma /= gamma.sum(axis=0)
            weights.append(gamma)
            ahead = np.take(self.emit, symbol, axis=1)
            ahead *= behind[:, :m]
            back = self.move @ ahead
            source = steps[step - 1][1][:, :m] if step else before[:, :m]
            share = source / (source * back).sum(axis=0)
            if step == 0:
                starts += gamma[:, opening[:m]].sum(axis=1)
                share[:, opening[:m]] = 0.0
            moves += self.move * (share @ ahead.T)
            back /= back.sum(axis=0)
            behind[:, :m] = back
        symbol = np.concatenate([x[0] for x in reversed(steps)])
        weight = np.concatenate(weights, axis=1)
        for state in range(k):
            emits[state] = np.bincount(symbol, weights=weight[state], minlength=emits.shape[1])
        return starts, moves, emits


def first_guess(mass: np.ndarray, states: int, seed: int = 5) -> Hmm:
    """States that persist, each with the class frequencies bent in its own way."""
    draw = np.random.default_rng(seed)
    emit = mass * draw.lognormal(0.0, 1.0, (states, len(mass)))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - 0.1 / max(1, states - 1))
    return Hmm(np.full(states, 1.0 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _training(batches: Iterator[pd.DataFrame], classes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Class sequences of the training documents, blocks joined up to ``_JOINED`` tokens, and their lengths."""
    symbols, lengths, waiting = [], [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            sizes, held = np.array(row.sizes, np.int64), np.array(row.held_out, bool)
            symbols.append(_classes(row, classes)[np.repeat(~held, sizes)])
            lengths.append(sizes[~held])
            waiting += len(symbols[-1])
            if waiting >= _JOINED:
                yield np.concatenate(symbols), np.concatenate(lengths)
                symbols, lengths, waiting = [], [], 0
    if symbols:
        yield np.concatenate(symbols), np.concatenate(lengths)


def estimate(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> Hmm:
    """Probabilities from expected counts, every count raised by the same small prior."""
    starts, moves, emits = starts + _PRIOR, moves + _PRIOR, emits + _PRIOR
    return Hmm(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=1, keepdims=True))


def baum_welch_step(blocks: DataFrame, model: Hmm, classes: int) -> Hmm:
    """One round: expected counts of all training documents, then new probabilities."""
    k = len(model.start)
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hmm, total = shared.value, None
        for symbols, sizes in _training(batches, classes):
            found = hmm.expected(Sequences(symbols, sizes))
            total = found if total is None else tuple(a + b for a, b in zip(total, found))
        if total is not None:
            flat = np.concatenate([x.ravel() for x in total])
            at = np.nonzero(flat)[0]
            yield pd.DataFrame({"at": at, "n": flat[at]})

    rows = blocks.select("held_out", "sizes", "classes", "tokens").mapInPandas(count, "at long, n double")
    summed = stored(rows.groupBy("at").agg(F.sum("n").alias("n")), "expected").toPandas()
    flat = np.zeros(k + k * k + (classes + 1) * k)
    flat[summed["at"].to_numpy(np.int64)] = summed["n"]
    shared.destroy()
    return estimate(flat[:k], flat[k:k + k * k].reshape(k, k), flat[k + k * k:].reshape(k, -1))


# ---- the operator ----------------------------------------------------------

def score_documents(
    docs: DataFrame, held_out, *, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
    classes: int = CLASSES, iterations: int = ITERATIONS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Score every row; ``held_out`` is a boolean column, learning uses the rows where it is not true.

    Columns: id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigram), score (the model), both log10 of the probability of the text. Words
    lie between ASCII white space, lower-cased in A-Z; each text ends with one
    closing mark, which is a token. Null text counts as empty. Without training
    rows all words are unknown and the model is its first guess. Repeated rows are
    scored each; null identifiers stay null; an empty table gives an empty result;
    other columns are ignored. ``classes`` must be a power of two.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(
        F.col(id_col).cast("string").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    blocks = stored(pack_blocks(source, block_chars, classes), "blocks", compression="zstd")

    own = blocks.select("block", F.posexplode("words").alias("at", "word"), "trained").select(
        "block", "at", "word", F.get("trained", F.col("at") + 1).alias("n")
    )
    counts = own.where("n > 0").groupBy("word").agg(F.sum("n").alias("c"))
    counts = stored(counts, "counts")
    marks = blocks.agg(F.sum(F.get("trained", F.lit(0)))).first()[0] or 0
    by_class = counts.groupBy(F.pmod(F.xxhash64("word"), F.lit(classes)).alias("class")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")
    ).toPandas()
    mass = np.ones(classes + 1)
    mass[by_class["class"].to_numpy(np.int64)] += (by_class["c"] + by_class["v"]).to_numpy(float)
    mass[classes] = marks + 1
    total = int(by_class["c"].sum()) + marks
    distinct = int(by_class["v"].sum()) + (marks > 0)

    model = first_guess(mass / mass.sum(), states)
    for _ in range(iterations):
        model = baum_welch_step(blocks, model, classes)

    looked_up = stored(
        own.select("block", "at", "word").join(counts, "word").groupBy("block")
        .agg(F.collect_list(F.struct("at", "c")).alias("known")),
        "looked_up", compression="zstd",
    )
    none = F.array().cast("array<struct<at:int,c:bigint>>")
    ready = blocks.drop("trained", "words").join(looked_up, "block", "left").select(
        "ids", "held_out", "sizes", "classes", "tokens",
        F.transform(F.coalesce("known", none), lambda x: x["at"]).alias("ats"),
        F.transform(F.coalesce("known", none), lambda x: x["c"]).alias("cs"),
    )
    shared = docs.sparkSession.sparkContext.broadcast((model, np.log10(mass)))
    base = float(np.log10(total + distinct + 1))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hmm, log_mass = shared.value
        for batch in batches:
            for row in batch.itertuples(index=False):
                sizes = np.array(row.sizes, np.int64)
                tokens, own = _tokens(row)
                seen, symbols = np.zeros(len(own) + 1), np.concatenate(([classes], own))[tokens]
                seen[0] = marks
                seen[np.array(row.ats, np.int64) + 1] = np.array(row.cs, float)
                starts = np.cumsum(sizes) - sizes
                logs = np.add.reduceat(np.log10(seen + 1)[tokens], starts)
                inner = np.add.reduceat(np.where(symbols < classes, np.log10(seen + 1)[tokens] - log_mass[symbols], 0.0), starts)
                yield pd.DataFrame({
                    "id": row.ids, "held_out": row.held_out, "n_tokens": sizes,
                    "n_known": np.add.reduceat((seen > 0)[tokens].astype(np.int64), starts),
                    "train_tokens": total, "base_score": logs - sizes * base,
                    "score": hmm.log_likelihood(Sequences(symbols, sizes)) / np.log(10) + inner,
                })

    columns = "id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return ready.mapInPandas(score, columns).withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
