"""Quality classifier by co-training.

Two classifiers see different sides of a document: its words and their shapes (text
view), and its metadata: language, source and declared length (page view). Both are
linear over hashed features, so there is no vocabulary: no word is left out, and a model
is ``FEATURES`` numbers whatever the corpus. Both start from the labelled documents. In
every round both are calibrated on a fold of the labelled documents that neither has
learned from; each then labels the unlabelled documents of which it is sure after
calibration, and the other one learns from these too. At the end the calibrated views
are combined into one score for every document.

The rows that are learned from are bounded: at most ``max_labelled`` labelled documents,
half of each kind or all of a rarer one, the first by the hash of their identifiers; and
in every round, per view and kind, the ``max_open`` unlabelled documents of which the
view is surest, out of all. A fifth of each kind is the calibration fold, weighted back
to the shares of the whole labels table. Scoring reads all documents whole, in one pass
without a shuffle for each round and one for the result.

Training rows are dealt to shares of ``SHARE`` rows. Each share is learned from by a task
of its own, and the weights are averaged, each feature's by the rows that hold it.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import stored

#: Bounds of the labelled rows of the training set, and of the unlabelled ones by round, view and kind.
MAX_LABELLED, MAX_OPEN = 12_000, 3_000
FEATURES, SHARE = 1 << 18, 4_000
ROUNDS, SURE, THRESHOLD = 2, 0.95, 0.5
EPOCHS, RATE, RIDGE = 6, 1.0, 1e-3
GRAIN = 1 << 20
_SPELLINGS = 1 << 18  # words whose features a task remembers
_TEXT, _PAGE = 0, 1
_VIEWS = (_TEXT, _PAGE)
_META = ("lang", "source", "n_chars")


def fit_for_training() -> Column:
    """The label to learn: of good quality, and not toxic where that is known."""
    return (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)


# ---- views -----------------------------------------------------------------

_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


_WORD = zlib.crc32(b"word ")  # a checksum goes on from that of the first part


class TextFeatures(dict):
    """Features of a token: its words in lower case, and its shape, which tells capitals, letters, digits and other signs.

    Plain words in small letters are the most, share one shape, and are not remembered.
    """

    def __init__(self) -> None:
        self.shapes: dict[str, int] = {}

    def _shape(self, shape: str) -> int:
        if shape not in self.shapes:
            self.shapes[shape] = _feature(f"shape {shape}")
        return self.shapes[shape]

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= _SPELLINGS:
            self.clear()
            self.shapes.clear()
        core = token.rstrip(string.punctuation)
        low = core.lower()
        if core.isalpha() and low.isalpha():  # one word, and signs behind it
            shape = ("A" if len(core) > 1 and core.isupper() else "a") + token[len(core):]
            words = {zlib.crc32(low.encode(), _WORD) % FEATURES}
        else:
            shape = _LETTERS.sub(lambda m: "A" if len(m.group()) > 1 and m.group().isupper() else "a", token)
            shape, words = _DIGITS.sub("0", shape), {_feature(f"word {w}") for w in _LETTERS.findall(token.lower())}
        found = self[token] = (*words, self._shape(shape))
        return found

    def of(self, text: str | None) -> np.ndarray:
        """The distinct features of a text in order."""
        tokens = set((text or "").split())
        plain = [t for t in tokens if t.islower() and t.isalpha()]
        tokens.difference_update(plain)
        words = np.array([zlib.crc32(t.encode(), _WORD) for t in plain], np.int64) % FEATURES
        others = np.array(list(chain.from_iterable(map(self.__getitem__, tokens))), np.int64)
        return np.unique(np.concatenate([words, others, [self._shape("a")] if plain else []]).astype(np.int64))


def page_features(lang: object, source: object, n_chars: object) -> np.ndarray:
    """Language, source and magnitude of the declared length, and the first with the last; unknown ones as such."""
    size = "unknown" if pd.isna(n_chars) else max(0, int(n_chars)).bit_length()
    names = {f"lang {lang}", f"source {source}", f"size {size}", f"lang {lang} size {size}"}
    return np.array(sorted({_feature(n) for n in names}), np.int64)


def margin(weights: np.ndarray, features: np.ndarray) -> float:
    """Sum of the weights; the last one belongs to every document."""
    return float(weights[features].sum() + weights[-1])


def _inputs(docs: DataFrame, text_col: str) -> list[Column]:
    kinds = {"lang": "string", "source": "string", "n_chars": "double"}
    meta = [(F.col(f"`{c}`") if c in docs.columns else F.lit(None)).cast(kinds[c]) for c in _META]
    return [F.col(f"`{text_col}`"), *meta]


def _cleaned(values: pd.Series) -> list:
    return [None if pd.isna(v) else v for v in values]


def _featured(docs: DataFrame, text_col: str) -> Column:
    """The features of both views, as a struct of two arrays."""

    @F.pandas_udf("text array<int>, page array<int>")
    def features(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        known = TextFeatures()
        for text, lang, source, n_chars in batches:
            meta = zip(_cleaned(lang), _cleaned(source), n_chars)
            yield pd.DataFrame({"text": [known.of(t) for t in text], "page": [page_features(*m) for m in meta]})

    return features(*_inputs(docs, text_col))


def _margins(docs: DataFrame, text_col: str, weights: list[np.ndarray]) -> Column:
    """The margins of both views, as a struct of two numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("text double, page double")
    def margins(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        known, (of_text, of_page) = TextFeatures(), sent.value
        for text, lang, source, n_chars in batches:
            meta = zip(_cleaned(lang), _cleaned(source), n_chars)
            yield pd.DataFrame({
                "text": [margin(of_text, known.of(t)) for t in text],
                "page": [margin(of_page, page_features(*m)) for m in meta],
            })

    return margins(*_inputs(docs, text_col))


# ---- fitting ---------------------------------------------------------------

def logistic(
    features: np.ndarray, labels: np.ndarray, rounds: int = 30, ridge: float = 1e-3, weights: np.ndarray | None = None
) -> np.ndarray:
    """Weights and intercept of a small logistic regression by Newton's method, steps halved until they gain."""
    x = np.column_stack([features, np.ones(len(features))])
    w, by = np.zeros(x.shape[1]), np.ones(len(x)) if weights is None else weights

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((by * (np.logaddexp(0, z) - labels * z)).sum() + ridge / 2 * w @ w)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (by * (labels - p)) - ridge * w
        step = np.linalg.solve((x * (by * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        now = loss(w)
        for _ in range(30):
            if loss(w + step) <= now:
                w = w + step
                break
            step = step / 2
    return w


def learn(rows: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights after ``EPOCHS`` passes of adaptive gradient steps over (features, label), and how many rows hold each."""
    w, squares, held = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8), np.zeros(FEATURES + 1)
    for features, _ in rows:
        held[features] += 1
    held[-1] = len(rows)
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            features, y = rows[i]
            off = 1 / (1 + np.exp(-np.clip(margin(w, features), -30, 30))) - y
            step = off + RIDGE * w[features]
            squares[features] += step * step
            w[features] -= RATE * step / np.sqrt(squares[features])
            squares[-1] += off * off
            w[-1] -= RATE * off / np.sqrt(squares[-1])
    return w, held


def _learned(share: pd.DataFrame) -> pd.DataFrame:
    """Both views learned from a share of the rows: weights times rows, and rows, by feature."""
    share, out = share.sort_values("id", kind="stable"), []
    for view, column in zip(_VIEWS, ("text", "page")):
        own = share[[bool(use[view]) for use in share["use"]]]
        w, held = learn(list(zip(own[column], own["y"])))
        at = np.flatnonzero(held)
        out.append(pd.DataFrame({"view": view, "feature": at, "weighed": w[at] * held[at], "held": held[at]}))
    return pd.concat(out)


def _fit(rows: DataFrame) -> list[np.ndarray]:
    """Weights of both views from (id, y, text, page, use): what a row is used for is in ``use``, by view."""
    shares = max(1, -(-rows.count() // SHARE))
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(shares)))
    sums = dealt.groupBy("share").applyInPandas(_learned, "view int, feature int, weighed double, held double")
    # Added in the order of their size, so that a result does not depend on which share came first.
    added = sums.groupBy("view", "feature").agg(
        F.aggregate(F.array_sort(F.collect_list("weighed")), F.lit(0.0), lambda a, b: a + b).alias("weighed"),
        F.sum("held").alias("held"),
    ).toPandas()  # at most a number for each feature and view
    weights = [np.zeros(FEATURES + 1) for _ in _VIEWS]
    for view in _VIEWS:
        own = added[added["view"] == view]
        # Whole multiples of a power of two: their sums are exact, in whatever order features come.
        weights[view][own["feature"].to_numpy()] = np.round((own["weighed"] / own["held"]).to_numpy() * GRAIN) / GRAIN
    return weights


@dataclass
class Quality:
    """The weights of both views, their calibration (slope, intercept) and how they are combined."""

    weights: list[np.ndarray]
    calibration: list[np.ndarray]
    combined: np.ndarray


def _calibrated(fold: pd.DataFrame, weights: list[np.ndarray], shares: dict[float, float]) -> Quality:
    """Both views calibrated, and combined, on rows that they have not learned from."""
    y, by = fold["y"].to_numpy(), fold["y"].map(shares).to_numpy()
    calibration, logits = [], []
    for view, column in zip(_VIEWS, ("text", "page")):
        margins = np.array([margin(weights[view], features) for features in fold[column]])
        fitted = logistic(margins[:, None], y, weights=by)
        calibration.append(fitted)
        logits.append(margins * fitted[0] + fitted[1])
    # What the views add to the share of good documents; held towards zero, as one of them may tell next to nothing.
    prior = float(np.log((by * y).sum() / (by * (1 - y)).sum()))
    a, b, c = logistic(np.column_stack(logits) - prior, y, ridge=1.0, weights=by)
    return Quality(weights, calibration, np.array([a, b, c - (a + b) * prior]))


def co_train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target: Column | None = None,
    max_labelled: int = MAX_LABELLED, max_open: int = MAX_OPEN, rounds: int = ROUNDS, sure: float = SURE,
) -> Quality | float:
    """Fit on the labelled documents; the share of good ones if they are not of both kinds."""
    spark = docs.sparkSession
    judged = labels.select(F.col(f"`{id_col}`").alias("id"), (target if target is not None else fit_for_training()).alias("y"))
    judged = judged.where("id is not null and y is not null").groupBy("id").agg(F.min("y").cast("double").alias("y"))
    own = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *[F.col(c) for c in _META if c in docs.columns]
    ).where("id is not null")
    # Only identifiers are shuffled to the labels; the chosen ones are few, so the texts need not be.
    known = stored(own.select("id").distinct().join(judged, "id").withColumn("place", F.xxhash64("id")), "known")
    kinds = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    good, bad = kinds.get(1.0, 0), kinds.get(0.0, 0)
    if not good or not bad:
        return good / (good + bad) if good + bad else 1.0
    half = max(1, max_labelled // 2)
    room = {1.0: max(half, max_labelled - bad), 0.0: max(half, max_labelled - good)}

    def chosen(y: float) -> DataFrame:
        return known.where(F.col("y") == y).orderBy("place", "id").limit(room[y])

    # A bounded number of identifiers; of a kind with a single document that one is learned from and calibrated on.
    rank = F.row_number().over(Window.partitionBy("y").orderBy("place", "id"))
    picked = chosen(1.0).unionByName(chosen(0.0)).withColumn("rank", rank).select("id", "y", "rank")
    examples = _examples(own, picked, "training")
    alone = F.col("y").isin([y for y, n in kinds.items() if n == 1])
    both = F.array(F.lit(True), F.lit(True))
    taught = examples.where((F.col("rank") % 5 != 1) | alone).select("id", "y", "text", "page", both.alias("use"))
    fold = examples.where("rank % 5 = 1").select("id", "y", "text", "page").toPandas().sort_values(["y", "id"])
    shares = {1.0: good / (fold["y"] == 1.0).sum(), 0.0: bad / (fold["y"] == 0.0).sum()}
    shares = {y: share / min(shares.values()) for y, share in shares.items()}
    model, more = _calibrated(fold, _fit(taught), shares), taught
    for turn in range(rounds):
        sure_ones = _sure(own, known.select("id"), model, sure, max_open, f"seen_{turn}")
        if not sure_ones:
            break
        found = spark.createDataFrame(sure_ones, f"id {own.schema['id'].dataType.simpleString()}, y double, use array<boolean>")
        more = taught.unionByName(_examples(own, found, f"open_{turn}").select(*taught.columns))
        model = _calibrated(fold, _fit(more), shares)
    return model


def _examples(docs: DataFrame, picked: DataFrame, name: str) -> DataFrame:
    """The rows of ``picked``, whose number is bounded, with the features of their documents; one row for each identifier."""
    some = docs.join(F.broadcast(picked), "id")
    some = some.withColumn("f", _featured(some, "text")).select(*picked.columns, "f.text", "f.page")
    return stored(some.dropDuplicates(["id"]), name, compression="zstd")


def _sure(docs: DataFrame, labelled: DataFrame, model: Quality, sure: float, bound: int, name: str) -> list[tuple]:
    """(id, y, use) of the unlabelled documents of which a view is sure after calibration, for the other one to learn from.

    All documents are scored, and the scores of the labelled ones are left out; of each
    view and kind the surest ``bound`` are taken.
    """
    seen = docs.select("id", _margins(docs, "text", model.weights).alias("m")).groupBy("id").agg(F.min("m").alias("m"))
    seen = seen.join(labelled, "id", "left_anti")
    logits = [F.col(f"m.{c}") * F.lit(float(a)) + F.lit(float(b)) for c, (a, b) in zip(("text", "page"), model.calibration)]
    seen = stored(seen.select("id", *[logit.alias(f"logit_{view}") for view, logit in zip(_VIEWS, logits)]), name)
    limit, found = float(np.log(sure / (1 - sure))), {}
    for view in _VIEWS:
        for y, sign in ((1.0, 1.0), (0.0, -1.0)):
            logit = F.col(f"logit_{view}") * F.lit(sign)
            rows = seen.where(logit >= limit).orderBy(logit.desc(), "id").limit(bound).select("id").collect()
            for r in rows:
                use = [view == _PAGE, view == _TEXT]  # the view that learns is the other one
                found.setdefault((r["id"], y), [False, False])
                found[r["id"], y] = [a or b for a, b in zip(found[r["id"], y], use)]
    # Where the views contradict each other, neither is believed.
    return [(i, y, use) for (i, y), use in sorted(found.items()) if (i, 1.0 - y) not in found]


# ---- scoring ---------------------------------------------------------------

def _sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _scores(docs: DataFrame, model: Quality | float, text_col: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with what the scores need, and the columns score, text_score and page_score."""
    names = ("score", "text_score", "page_score")
    if not isinstance(model, Quality):
        return docs, [F.lit(float(model)).alias(n) for n in names]
    fresh = "margins"
    while fresh in docs.columns:
        fresh += "_"
    seen = docs.withColumn(fresh, _margins(docs, text_col, model.weights))
    logits = [F.col(f"{fresh}.{c}") * F.lit(float(a)) + F.lit(float(b)) for c, (a, b) in zip(("text", "page"), model.calibration)]
    a, b, c = (float(x) for x in model.combined)
    score = logits[_TEXT] * F.lit(a) + logits[_PAGE] * F.lit(b) + F.lit(c)
    return seen, [_sigmoid(x).alias(n) for x, n in zip((score, *logits), names)]


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, **options,
) -> DataFrame:
    """(id, score, text_score, page_score, accepted) of every row.

    ``labels`` has the identifier, quality and toxic (0/1); by default a document
    is good if its quality is 1 and it is not marked toxic. Rows without an
    identifier or label are no label; of several labels of one document the worst
    counts. Null text counts as empty, a null or missing language, source or
    length as unknown; rows without an identifier are scored but not learned from;
    repeated rows are scored each. Where the labels of the documents do not hold
    both kinds, every score is the share of good labels (1.0 without any). An empty table gives an empty result; other columns are ignored.
    """
    model = co_train(docs, labels, id_col=id_col, text_col=text_col, **options)
    seen, (score, text_score, page_score) = _scores(docs, model, text_col)
    return seen.select(F.col(f"`{id_col}`").alias(id_col), score, text_score, page_score).withColumn(
        "accepted", F.col("score") >= threshold
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, **options,
) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` accepts, with the columns they had."""
    model = co_train(docs, labels, id_col=id_col, text_col=text_col, **options)
    seen, (score, _, _) = _scores(docs, model, text_col)
    return seen.where(score >= threshold).select(*[f"`{n}`" for n in docs.columns])
