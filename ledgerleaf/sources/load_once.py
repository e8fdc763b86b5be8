"""Bulk loads that can be repeated without loading a file twice.

The table has a partition for each file, named by the digest of its content: the ledger of
what was loaded is the table itself, so data and ledger cannot disagree. A load replaces
just the partitions of its files, so one that broke off is simply run again.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions.names import quoted
from ledgerleaf.scratch import qualified, settle
from ledgerleaf.sources import csv_ranges
from ledgerleaf.sources.csv import read_csv

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(csv_ranges)

LEDGER = "load_digest"
BLOCK_BYTES = 64 << 20
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch.to_pylist():
            digest = hashlib.sha256()
            with csv_ranges._open(part["path"]) as file:
                file.seek(part["start"])
                left = part["end"] - part["start"]
                while left and (chunk := file.read(min(left, csv_ranges.CHUNK_BYTES))):
                    digest.update(chunk)
                    left -= len(chunk)
            row = [[part["file"]], [part["start"]], [digest.hexdigest()]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["file", "start", "digest"])


def file_digests(spark: SparkSession, path: str | list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, digest of all files: SHA-256 of the digests of their blocks, which tasks share out.

    Files without a byte are left out.
    """
    paths = [qualified(spark, p) for p in ([path] if isinstance(path, str) else path)]
    files = spark.read.format("binaryFile").load(paths).where("length > 0")
    blocks = files.select(
        F.col("_metadata.file_path").alias("file"),
        "path",
        "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))).alias(
            "start"
        ),
    ).withColumn("end", F.least(F.col("start") + block_bytes, "length"))
    found = csv_ranges._spread(settle(blocks, "blocks")).mapInArrow(
        _digests, "file string, start long, digest string"
    )
    in_order = F.array_sort(F.collect_list(F.struct("start", "digest")))
    whole = found.groupBy("file").agg(in_order.alias("blocks"))
    return whole.select("file", F.sha2(F.array_join("blocks.digest", ","), 256).alias("digest"))


@contextmanager
def _only_own_partitions(spark: SparkSession) -> Iterator[None]:
    """Inside, an overwrite replaces the partitions it has rows for, and no others."""
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE, before)


def load_once(
    spark: SparkSession,
    csv_path: str | list[str],
    table: str,
    schema,
    path: str | None = None,
) -> DataFrame:
    """Load CSV files into ``table``, each content once however often this runs; the table's rows.

    The table is created when absent, with a column ``load_digest`` that the result leaves
    out; ``path`` makes it an external table in that folder. Files of equal content count
    once, whatever their names; rows that repeat inside a file are kept. Folders are
    not searched for folders. Concurrent loads of the same table are not coordinated.
    """
    digests = settle(file_digests(spark, csv_path), "digests")
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], schema).withColumn(LEDGER, F.lit("").cast("string"))
        writer = empty.write.format("parquet").partitionBy(LEDGER)
        (writer if path is None else writer.option("path", path)).saveAsTable(table)
    known = spark.table(table).select(F.col(LEDGER).alias("digest")).distinct()
    new = digests.groupBy("digest").agg(F.min("file").alias("file")).join(known, "digest", "left_anti")
    new = settle(new, "new-files")
    # The reader takes a list of paths.
    paths = [row.file for row in new.select("file").collect()]
    columns = [c for c in spark.table(table).columns if c != LEDGER]
    if paths:
        rows = read_csv(spark, paths, spark.table(table).drop(LEDGER).schema)
        named = rows.select(*[quoted(c) for c in columns], F.col("_metadata.file_path").alias("_load_file"))
        loads = new.select(F.col("file").alias("_load_file"), F.col("digest").alias(LEDGER))
        ready = named.join(loads, "_load_file").select(*[quoted(c) for c in columns], LEDGER)
        with _only_own_partitions(spark):
            ready.write.insertInto(table, overwrite=True)
    return spark.table(table).drop(LEDGER)
