"""Exact dedup: tree-merge of sorted digest runs.

Every document is dealt to one of ``runs`` runs. A run holds, sorted by digest,
one entry per distinct text: the 64-bit digest, what verifies it (SHA-256 and
length), the identifier that stays and the number of copies. In each round
groups of ``fan_in`` neighbouring runs exchange their entries and merge them;
two entries become one only if digest and verification agree. After
log(runs) / log(fan_in) rounds one run is left. The way back down attaches its
entry to every (run, digest) and from there to the documents, so that a text
copied a billion times meets its entry in ``runs`` places and not in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import lower_ascii, shuffle_width, stored

_ENTRY = ["digest", "sha", "n_bytes"]


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
    keep: str = "smallest", runs: int | None = None, fan_in: int = 8,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. ``keep`` names the
    identifier that stays, "smallest" or "largest". ``runs`` defaults to the
    session's shuffle width.

    Null text counts as empty text; rows without an identifier never stay
    unless the whole group lacks one; rows that repeat both identifier and text
    count one by one and are kept alike, as nothing tells them apart. An empty
    table gives an empty result. Other columns of ``docs`` are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    best = F.min if keep == "smallest" else F.max
    span = runs or shuffle_width(docs.sparkSession)
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    digests = stored(
        docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
            "id",
            F.pmod(F.xxhash64("id"), F.lit(span)).cast("int").alias("run"),
            F.xxhash64("text").alias("digest"),
            F.unhex(F.sha2("text", 256)).alias("sha"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        ),
        "digests",
    )
    leaves = stored(
        digests.groupBy("run", *_ENTRY)
        .agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .sortWithinPartitions("run", *_ENTRY),
        "runs",
    )
    merged = leaves
    while span > 1:
        span = -(-span // fan_in)
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", *_ENTRY)
            .agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
            .sortWithinPartitions("run", *_ENTRY)
        )
    resolved = stored(
        leaves.select("run", *_ENTRY).join(stored(merged.drop("run"), "merged"), _ENTRY), "resolved"
    )
    return digests.join(resolved, ["run", *_ENTRY]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
