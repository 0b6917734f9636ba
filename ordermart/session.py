"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "ordermart", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings the jobs rely on.

    Everything can be overridden by ``conf`` or by ``spark-submit``; on a
    cluster neither the master nor the shuffle width is set here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Call sites of every column operation are costly to record.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: dict[str, str] = {}
_seen: set[tuple[str, str]] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may name, or fall back to, a folder of this machine. YARN has
    a store of its own and must name a folder in it; on any other cluster the folder may
    be a mount that all machines share, which a small write shows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.master.startswith("local"):
        if named:
            return named.rstrip("/")
        if context.applicationId not in _fallback:
            _fallback[context.applicationId] = tempfile.mkdtemp(prefix="ordermart-")
        return _fallback[context.applicationId]
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    scheme = named.partition("://")[0] if "://" in named else named.partition(":/")[0] if ":/" in named else ""
    folder = named.rstrip("/")
    if scheme == "file" or not scheme and _default_scheme(spark) == "file":
        if context.master == "yarn" or not _is_shared(spark, folder):
            raise ValueError(f"spark.checkpoint.dir is {named}, a folder of one machine; name one shared by all executors")
    return folder


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds what the tasks write to the folder; asked once per application."""
    context = spark.sparkContext
    slot = (context.applicationId, folder)
    if slot not in _seen:
        tasks, path = max(2, context.defaultParallelism), f"{folder}/ordermart-{uuid.uuid4().hex}/shared"
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        if spark.read.schema("id long").parquet(path).count() < tasks:
            return False
        _seen.add(slot)
    return True


def _default_scheme(spark: SparkSession) -> str:
    """File system of paths without a scheme."""
    return spark.conf.get("spark.hadoop.fs.defaultFS", "file:///").partition(":")[0]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable without overriding a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/ordermart-{uuid.uuid4().hex}/{name}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Every query that ends inside removes its shuffles, which nothing may read again."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds, in whatever store it lies; False if there was none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty if it does not exist."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(conf)
    return sorted(s.getPath().getName() for s in store.listStatus(target)) if store.exists(target) else []
