"""Shared working folder for intermediate tables.

Intermediate results that several later steps need, or whose real size has to
be known before a join, are written here as Parquet. The table is read back
from the shared folder, so losing an executor never loses the result, and the
optimizer sees its true size: a side below
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a larger one is shuffled.
Once a table is stored, Spark removes the shuffle files behind it, which otherwise
stay until the driver collects garbage.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
# Paths of the tables of each open block of :func:`passing_tables`, innermost last.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the default file system, unless that is local."""
    if "://" in path or path.startswith("file:"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return path if default.startswith("file:") else default.rstrip("/") + path


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    The setting is taken as it is: a plain path may be a shared mount. Only a
    local-mode session without it gets a temporary folder, which goes when
    Python ends; on a cluster the setting is required.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if root:
        return qualified(spark, root.rstrip("/"))
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        own = _local_roots[application] = tempfile.mkdtemp(prefix="ledgerleaf-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return _local_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go as soon as it has ended."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def settle(
    df: DataFrame, label: str = "table", options: dict[str, int] | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder, with Parquet ``options``, and return the stored table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for block in _blocks.get()[-1:]:
        block.append(path)
    with _shuffles_removed(spark):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def noted_tables() -> Iterator[list[str]]:
    """The paths of tables that are settled inside and not removed by a block further in."""
    paths: list[str] = []
    token = _blocks.set((*_blocks.get(), paths))
    try:
        yield paths
    finally:
        _blocks.reset(token)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled inside go at the end of the block.

    For steps whose result is one small table: that is settled by :func:`settle_outside`,
    and nothing else from the block may be used after it. Where the block fails, its
    tables stay.
    """
    with noted_tables() as paths:
        yield
    remove_tables(spark, paths)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables; those that are gone already are passed over."""
    context = spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def reads_any(df: DataFrame, paths: list[str]) -> bool:
    """Whether ``df`` reads a file of one of the stored tables ``paths``."""
    names = {path.rsplit("/", 1)[1] for path in paths}
    return bool(names) and any(names & set(file.split("/")) for file in df.inputFiles())


def settle_outside(df: DataFrame, label: str = "table") -> DataFrame:
    """:func:`settle` for what is needed after the innermost block of :func:`passing_tables`."""
    token = _blocks.set(_blocks.get()[:-1])
    try:
        return settle(df, label)
    finally:
        _blocks.reset(token)
