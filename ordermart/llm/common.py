"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.session import remove_path, scratch_path, shuffles_removed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a maximal run of anything but blank, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
#: Paths written so far, for every ``passing_tables`` that is open.
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """What is ``stored`` inside is removed at the end, so nothing may read it later, but for ``lasting`` tables.

    Shuffles of the queries that end inside go with them.
    """
    paths: list[str] = []
    opened = _passing.set((*_passing.get(), paths))
    try:
        with shuffles_removed(spark):
            yield
    finally:
        _passing.reset(opened)
        for path in paths:
            remove_path(spark, path.rpartition("/")[0])


def stored(frame: DataFrame, name: str, compression: str = "snappy", lasting: bool = False) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives Spark the
    true size of the table when it plans the joins that follow. A ``lasting``
    table outlives the innermost ``passing_tables``.
    """
    spark = frame.sparkSession
    path, scopes = scratch_path(spark, name), _passing.get()
    if len(scopes) > lasting:
        scopes[-1 - lasting].append(path)
    with shuffles_removed(spark):
        frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text, where ``lower`` does the same, takes the fast way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that none of ``taken`` equals, whatever the case."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = f"{name}_"
    return name


class Numbering(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
