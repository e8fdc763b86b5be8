"""All rows as one JSON array in one file, written and read by many tasks at once.

Rows are cut by range, so no task sorts all of them. The sizes of the ranges give the
offset of each in the file, and every task writes its rows there. A task that runs again
writes the same bytes to the same place. Every object has a line of its own, so the file is
also read in ranges of bytes, where a reader of whole arrays holds all rows in one task.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.scratch import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Stands before every row: two bytes each.
FIRST, NEXT = b"[\n", b",\n"
END, EMPTY = b"\n]\n", b"[]\n"


def _writer(path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        descriptor = os.open(path, os.O_WRONLY)
        part = at = None
        try:
            for batch in batches:
                parts, starts, pieces = (batch.column(i).to_pylist() for i in range(3))
                begin = 0
                while begin < len(parts):
                    end = begin
                    while end < len(parts) and parts[end] == parts[begin]:
                        end += 1
                    if parts[begin] != part:
                        part, at = parts[begin], starts[begin]
                    marks = [FIRST if at == 0 else NEXT, *[NEXT] * (end - begin - 1)]
                    rows = pieces[begin:end]
                    data = b"".join(m + row.encode() for m, row in zip(marks, rows, strict=True))
                    done = 0
                    while done < len(data):
                        done += os.pwrite(descriptor, data[done:], at + done)
                    at += len(data)
                    begin = end
                yield pa.RecordBatch.from_arrays([pa.array([len(parts)])], ["rows"])
            os.fsync(descriptor)
        finally:
            os.close(descriptor)

    return write


def write_json_array(df: DataFrame, path: str, order: list[str]) -> None:
    """Replace the file ``path`` by an array of one object for each row, in ``order``.

    Rows equal in ``order`` go by their text; null fields are left out. The path is that
    of a file that driver and executors see, in a shared folder that can be written at any
    offset; object stores cannot. The file appears whole, by a rename. Without rows the
    array is empty.
    """
    if "://" in path and not path.startswith("file:"):
        raise ValueError(f"{path}: one file written by many tasks takes a shared folder")
    target = re.sub("^file:/+", "/", path)
    keys = [F.col("`" + c.replace("`", "``") + "`").alias(f"key{i}") for i, c in enumerate(order)]
    rows = df.select(*keys, F.to_json(F.struct("*")).alias("piece"))
    names = [f"key{i}" for i in range(len(order))] + ["piece"]
    # The place in a partition: what monotonically increasing numbers hold in their low bits.
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = settle(
        rows.repartitionByRange(*names)
        .sortWithinPartitions(*names)
        .select(F.spark_partition_id().alias("part"), inside.alias("inside"), "piece"),
        "pieces",
    )
    sizes = stored.groupBy("part").agg(F.sum(F.octet_length("piece") + len(NEXT)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    starts = settle(starts, "starts")
    total = starts.select(F.sum("size")).first()[0] or 0
    draft = f"{target}.{uuid.uuid4().hex}"
    with open(draft, "wb") as file:
        if total:
            file.seek(total)
        file.write(END if total else EMPTY)
    try:
        placed = stored.join(starts.select("part", "start"), "part").repartition("part")
        written = (
            placed.sortWithinPartitions("part", "inside")
            .select("part", "start", "piece")
            .mapInArrow(_writer(draft), "rows long")
        )
        written.agg(F.sum("rows")).collect()
        os.replace(draft, target)
    finally:
        Path(draft).unlink(missing_ok=True)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a file that :func:`write_json_array` wrote, by parts of the file.

    Fields that are missing are null. A line that is neither one object nor a bracket is
    an error.
    """
    lines = spark.read.option("lineSep", "\n").text(path).where(~F.col("value").isin("[", "]", "[]"))
    # The comma behind an object stands at the end of its line.
    rows = F.from_json(F.rtrim("value", F.lit(",")), schema, {"mode": "FAILFAST"})
    return lines.select(rows.alias("row")).select("row.*")
