"""Text sources parsed once: typed copies, row counts, and the rows that do not fit.

A CSV source is parsed by one job, which writes it as Parquet and counts its rows on the
way (``Observation``). The gate reads these counts, and everything behind it reads the
copies. Rows that do not fit the declared types either fail that job or are set apart
with the reason for each field and their place in the file.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.schemas import QUARANTINE, SOURCES, Table
from ordermart.sources.readers import CORRUPT, INGEST


@dataclass(frozen=True)
class Staged:
    """Typed copies of the sources (None for an absent one), rows that fit, and rows that do not, by source."""

    frames: dict[str, DataFrame | None]
    counts: dict[str, int | None]
    bad_counts: dict[str, int]
    quarantined: DataFrame


def stage(
    spark: SparkSession, frames: Mapping[str, DataFrame | None], path: str, tables: Mapping[str, Table] = SOURCES
) -> Staged:
    """Write every source to ``path`` in one job each and count its rows.

    Frames come from ``read_present`` with ``ingest``; those read without ``strict``
    carry their misfits, which ``quarantined`` lists as ``misfits`` does.
    """

    def one(name: str) -> tuple[int | None, int]:
        frame = frames[name]
        if frame is None:
            return None, 0
        misfit = F.col(CORRUPT).isNotNull() if CORRUPT in frame.columns else F.lit(False)
        seen = Observation(name)
        frame.observe(seen, F.count_if(~misfit).alias("fit"), F.count_if(misfit).alias("bad")).write.parquet(f"{path}/{name}")
        return seen.get["fit"], seen.get["bad"]

    # The jobs do not depend on each other, so small ones fill the gaps of the large one.
    with ThreadPoolExecutor(max(1, len(frames))) as pool:
        pending = {name: pool.submit(inheritable_thread_target(spark)(one), name) for name in frames}
        counted = {name: done.result() for name, done in pending.items()}

    def copy(name: str) -> DataFrame:
        return spark.read.schema(frames[name].schema).parquet(f"{path}/{name}")

    fitting, bad = {}, spark.createDataFrame([], QUARANTINE.schema)
    for name, frame in frames.items():
        fitting[name] = None if frame is None else copy(name)
        if frame is not None and CORRUPT in frame.columns:
            fitting[name] = copy(name).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
            if counted[name][1]:
                bad = bad.unionByName(misfits(copy(name), tables[name]))
    return Staged(fitting, {n: fit for n, (fit, _) in counted.items()}, {n: b for n, (_, b) in counted.items()}, bad)


def misfits(frame: DataFrame, table: Table) -> DataFrame:
    """Rows of a source that did not fit: where they stand, why, and their text.

    The text is cut into fields again, and every field that is not of its declared type
    is a reason; a row without one has too few or too many fields.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in table.schema.fields])
    cut = F.from_csv(F.col(CORRUPT), texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"escape": '"'})

    def reason(field: T.StructField) -> Column:
        text = F.col(f"_cut.{field.name}")
        kind = field.dataType.simpleString()
        return F.when(text.isNotNull() & text.try_cast(field.dataType).isNull(), F.lit(f"{field.name}: not a {kind}"))

    reasons = F.array_compact(F.array(*[reason(f) for f in table.schema.fields if not isinstance(f.dataType, T.StringType)]))
    shape = F.array(F.lit(f"row: not {len(table.columns)} fields"))
    return frame.filter(F.col(CORRUPT).isNotNull()).withColumn("_cut", cut).select(
        F.lit(table.name).alias("source"), F.col(f"{INGEST}.file").alias("file"), F.col(f"{INGEST}.start").alias("start"),
        F.col(f"{INGEST}.row").alias("row"), F.when(F.size(reasons) > 0, reasons).otherwise(shape).alias("reasons"),
        F.col(CORRUPT).alias("record"),
    )
