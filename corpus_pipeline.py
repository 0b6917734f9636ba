"""From raw documents to a training mix, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.common import stored, table
from ordermart.llm.decontamination import decontaminate
from ordermart.llm.line_dedup import line_dedup
from ordermart.llm.quality_classifier import keep_good
from ordermart.llm.simhash_dedup import simhash_dedup
from ordermart.llm.source_mixing import mix_sources

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays, and n_chars follows its text."""
    return line_dedup(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest identifier stays.

    Rows of one identifier are one document; rows without an identifier all stay.
    """
    groups = simhash_dedup(docs)
    kept = stored(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept")
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id is null"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The schedule by which the documents left are read; each of them at least once."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mix", mix),
]

#: SQL can express neither the classifier nor the fuzzy lines; see tests/llm/test_quality_and_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
