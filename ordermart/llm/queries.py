"""The corpus queries by name, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm.common import WORD, table
from ordermart.llm.decontamination import contaminated
from ordermart.llm.disclosure import BASE, personal_data
from ordermart.llm.exact_dedup import exact_dedup
from ordermart.llm.hmm_scoring import score_documents
from ordermart.llm.language_id import held_out_language_id
from ordermart.llm.line_dedup import line_dedup
from ordermart.llm.periodic_runs import periodic_runs
from ordermart.llm.quality_classifier import quality_scores
from ordermart.llm.simhash_dedup import simhash_dedup
from ordermart.llm.source_mixing import mix_sources
from ordermart.llm.suffix_dedup import remove_repeated_passages
from ordermart.llm.vector_codes import codebooks_digest, vector_codes, with_label_error
from ordermart.llm.warc_revisits import captures, resolve_revisits

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines")
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header fields are returned as sorted ``name: value`` lines."""
    found = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda h: F.concat(F.lower(h["name"]), F.lit(": "), h["value"]))
    return found.select(
        "record_id", "canonical_url", "response_id", "outcome", F.array_join(F.array_sort(lines), "\n").alias("headers")
    )


def op8_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return score_documents(table(spark, sf_dir, "documents"), F.crc32(key) % 7 == 2)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "consistency")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_language_id(table(spark, sf_dir, "documents"))


def with_repetition(docs: DataFrame) -> DataFrame:
    """Every tenth text, by the hash of its identifier, goes on with copies of some of its words from one of them on."""
    h, words = F.crc32(F.col("doc_id").cast("string")), F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    g, n = F.floor(h / 10), F.size("words")
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    unit = F.slice("words", start + 1, period)
    copies = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - start) / period).cast("int"))), 1, n - start)
    text = F.array_join(F.concat(F.slice("words", 1, start), copies), " ")
    chosen = (h % 10 == 0) & F.col("text").isNotNull()
    return docs.select("doc_id", "text", F.when(chosen, words).alias("words")).select(
        "doc_id", F.when(F.size("words") > 0, text).otherwise(F.col("text")).alias("text")
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repetition(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("early"), (-r["period"]).alias("short"),
        r["start"].alias("start"), r["period"].alias("period"),
    ))
    best = F.array_max(order)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_information_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *map(number, BASE),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, book = vector_codes(table(spark, sf_dir, "embeddings"))
    digits = F.transform("code", lambda entry: F.lpad(F.lower(F.hex(entry)), 2, "0"))
    return with_label_error(codes).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
        F.lit(codebooks_digest(book)).alias("codebooks_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_temperature_mixing": op2_temperature_mixing,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_simhash_dedup": op4_simhash_dedup,
        "op5_line_dedup": op5_line_dedup,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_warc_revisits": op7_warc_revisits,
        "op8_hmm_scoring": op8_hmm_scoring,
        "op9_decontamination": op9_decontamination,
        "op10_language_id": op10_language_id,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_information_sanitisation": op12_information_sanitisation,
        "op13_vector_codes": op13_vector_codes,
    }
