"""Mixing sources to target weights: temperature mixing with block permutations.

Token shares p of the sources are raised to an exponent a in [0, 1] and
normalised. A smaller exponent flattens the mix; it is bisected to the smallest
one at which the entropy of the weights has come up to the target and no source
is repeated more often than allowed. The weights are then realised as a
schedule: every source is cut into blocks by a hash, each epoch permutes the
blocks and the documents inside them anew, and a last partial epoch takes blocks
in their order until the token budget of the source is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import WORD, stored

#: Most blocks of one source; bounds the rows of the window that orders them.
MAX_BLOCKS = 4096
#: Each pass over the sources splits the bracket in 16, which is four bisections.
_SECTIONS, _PASSES = 16, 6


def token_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _key(source: Column) -> Column:
    """A key that tells a null source from an empty name."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _draw(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def mixing_exponent(
    sources: DataFrame, *, target_entropy: float = 0.95, max_epochs: float = 4.0, budget: float | None = None
) -> float:
    """Smallest exponent that respects both limits, rounded up to six decimals.

    ``sources`` has one row per source with its ``tokens``. ``target_entropy``
    is a share of the greatest possible entropy, ln(number of sources): the mix
    is flattened no further than that. ``max_epochs`` limits how often any
    source is read. 1.0 leaves the natural mix and is returned where even it
    breaks a limit, and for fewer than two sources with tokens.
    """
    sized = sources.where("tokens > 0").select(F.col("tokens").cast("double").alias("tokens"))
    total, number = sized.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if number < 2:
        return 1.0
    p = F.col("tokens") / F.lit(total)
    low, high = 0.0, 1.0
    for _ in range(_PASSES):
        points = [low + (high - low) * i / _SECTIONS for i in range(_SECTIONS)]
        sums = []
        for i, a in enumerate(points):
            sums += [
                F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"),
                F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"l{i}"),
                F.max(F.pow(p, F.lit(a - 1.0))).alias(f"most{i}"),
                F.min(F.pow(p, F.lit(a - 1.0))).alias(f"least{i}"),
            ]
        row = sized.agg(*sums).first()

        def allowed(i: int) -> bool:
            entropy = math.log(row[f"z{i}"]) - points[i] * row[f"l{i}"] / row[f"z{i}"]
            least = row[f"least{i}"] if budget is None else total * row[f"z{i}"] / budget
            return entropy <= target_entropy * math.log(number) and row[f"most{i}"] / least <= max_epochs

        first = next((i for i in range(_SECTIONS) if allowed(i)), _SECTIONS)
        low, high = (points[first - 1] if first else low), (points[first] if first < _SECTIONS else high)
        if first == 0:
            break
    return min(1.0, -(-high * 1e6 // 1) / 1e6)


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    target_entropy: float = 0.95, max_epochs: float = 4.0, budget: float | None = None,
    block_tokens: int = 1 << 20, seed: int = 7,
) -> DataFrame:
    """The schedule of the mix: one row per reading of a document.

    Columns: id, source, n_tokens, exponent, weight, epoch, block, unit_order,
    doc_order. Reading in the order (unit_order, doc_order) is the mix; a unit is
    one block of one source in one epoch. ``budget`` is the number of tokens of
    the whole mix; by default the smallest that reads every document at least
    once, so that nothing is left out and smaller sources are repeated. The
    document that crosses the budget of its source is still read.

    Documents without tokens (null, empty or blank text) ride along in every
    full epoch and use no budget; a source with such documents only is read
    once and has weight zero. A null source is a source of its own. Rows that
    repeat an identifier are read each. An empty table gives an empty schedule.
    Other columns of ``docs`` are ignored.
    """
    narrow = stored(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            _key(F.col(source_col)).alias("key"), token_count(F.col(text_col)).alias("n_tokens"),
        ),
        "tokens",
    )
    sources = stored(narrow.groupBy("key").agg(F.sum("n_tokens").alias("tokens")), "sources")
    exponent = mixing_exponent(sources, target_entropy=target_entropy, max_epochs=max_epochs, budget=budget)

    total = sources.agg(F.sum("tokens")).first()[0] or 0
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(exponent)))
    z, largest = sources.agg(F.sum(power), F.max(F.col("tokens") / power)).first()
    weight = F.coalesce(power / F.lit(z or 1.0), F.lit(0.0))
    size = float(budget) if budget is not None else (largest or 0.0) * (z or 0.0)
    quota = F.floor(weight * F.lit(size) + F.lit(0.5)).cast("long")
    plan = sources.select(
        "key",
        F.round(weight, 9).alias("weight"),
        F.when(F.col("tokens") > 0, F.call_function("div", quota, F.col("tokens")))
        .otherwise(F.lit(1)).cast("int").alias("full"),
        F.when(F.col("tokens") > 0, quota % F.col("tokens")).otherwise(F.lit(0)).alias("rest"),
        F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))))
        .cast("long").alias("blocks"),
    )

    readings = (
        narrow.join(stored(plan, "plan"), "key")
        .withColumn("epochs", F.col("full") + F.when(F.col("rest") > 0, 1).otherwise(0))
        .where("epochs > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    )
    doc_order = _draw(seed, F.col("epoch"), F.col("id"))
    readings = readings.withColumn("doc_order", doc_order).withColumn(
        "block", F.conv(F.substring("doc_order", 1, 8), 16, 10).cast("long") % F.col("blocks")
    ).withColumn("unit_order", _draw(seed, F.col("key"), F.col("epoch"), F.col("block")))

    partial = stored(readings.where("epoch = full"), "partial")
    by_unit = Window.partitionBy("key").orderBy("unit_order").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        partial.groupBy("key", "unit_order", "block").agg(F.sum("n_tokens").alias("unit_tokens"))
        .withColumn("unit_start", F.coalesce(F.sum("unit_tokens").over(by_unit), F.lit(0)))
        .select("key", "block", "unit_start")
    )
    inside = (
        Window.partitionBy("key", "block").orderBy("doc_order", "id", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    last = (
        partial.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(stored(starts, "starts"), ["key", "block"])
        .where(F.col("unit_start") + F.col("before") < F.col("rest"))
    )
    columns = [
        F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens",
        F.lit(exponent).alias("exponent"), "weight", F.col("epoch").cast("long").alias("epoch"), "block",
        F.substring("unit_order", 1, 16).alias("unit_order"), F.substring("doc_order", 1, 16).alias("doc_order"),
    ]
    return readings.where("epoch < full").select(*columns).unionByName(last.select(*columns))
