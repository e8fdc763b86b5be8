"""CSV files with line breaks inside quotes, cut into byte ranges.

Whether a line break ends a record depends on all quotes before it. A first pass counts
the quotes of each range; the sum of the ranges before tells whether a range begins inside
quotes. Then every range finds its first record by itself and reads on to the end of its
last one, so records reach tasks whole, without a shuffle, and ``from_csv`` takes them
apart. Files of a single range are read once.

Python on the executors only moves bytes. The Arrow file systems are used for access, as
for DBF files.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.scratch import qualified, settle
from ledgerleaf.sources import dbf_layout
from ledgerleaf.sources.dbf_layout import open_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(dbf_layout)

RANGE_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
MOST_TASKS = 20_000
QUOTE, LINE_FEED = ord('"'), ord("\n")
COMPRESSED = r"(?i)\.(gz|gzip|bz2|zst|lz4|snappy|deflate|xz)$"


def _open(path: str) -> pa.NativeFile:
    """``path`` as Spark names it, ``file:/a`` for local ones."""
    system, inner = open_path(re.sub("^file:/+", "/", path))
    return system.open_input_file(inner)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _count_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _ranges(batches):
        with _open(part["path"]) as file:
            file.seek(part["start"])
            left, quotes = part["end"] - part["start"], 0
            while left and (chunk := file.read(min(left, CHUNK_BYTES))):
                quotes += chunk.count(b'"')
                left -= len(chunk)
        columns = [[part["path"]], [part["start"]], [quotes]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["path", "start", "quotes"])


def _batch(data: bytes, ends: np.ndarray) -> pa.RecordBatch:
    """Records that lie behind each other in ``data``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
    records = pa.Array.from_buffers(pa.binary(), len(ends), buffers)
    return pa.RecordBatch.from_arrays([records], ["record"])


def _records(path: str, start: int, end: int, inside: bool) -> Iterator[pa.RecordBatch]:
    """The records that begin inside a range; ``inside`` tells whether it begins inside quotes."""
    with _open(path) as file:
        found = start == 0
        if not found:
            file.seek(start - 1)
            found = file.read(1) == b"\n" and not inside
        # Bytes of the record that is open, and where it begins.
        held: list[bytes] = []
        begin = at = start
        while chunk := file.read(CHUNK_BYTES):
            codes = np.frombuffer(chunk, dtype=np.uint8)
            # Adding up modulo 256 keeps what is odd.
            odd = np.cumsum(codes == QUOTE, dtype=np.uint8) & 1 != inside
            ends = np.flatnonzero((codes == LINE_FEED) & ~odd) + 1
            inside = bool(odd[-1])
            after = 0
            if not found and len(ends):
                found, after, ends = True, int(ends[0]), ends[1:]
                begin = at + after
            if found and begin < end:
                begins = np.concatenate([[begin], at + ends[:-1]])
                own = ends[: int(np.searchsorted(begins[: len(ends)], end))]
                if len(own):
                    data = b"".join([*held, chunk[after : own[-1]]])
                    yield _batch(data, own - after + sum(map(len, held)))
                    held, after, begin = [], int(own[-1]), at + int(own[-1])
                held.append(chunk[after:])
            at += len(chunk)
            if at >= end and not found or begin >= end:
                return
        if inside:
            raise ValueError(f"{path}: a quote is not closed")
        rest = b"".join(held)
        if found and rest:
            yield _batch(rest, np.array([len(rest)]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _ranges(batches):
        header = part["start"] == 0
        for records in _records(part["path"], part["start"], part["end"], part["inside"]):
            yield records.slice(1) if header else records
            header = False


def _spread(ranges: DataFrame) -> DataFrame:
    return ranges.repartition(max(1, min(MOST_TASKS, ranges.count())))


def _checked(text: Column) -> Column:
    """A record, or an error where a quote stands inside an unquoted value.

    Without doubled quotes, what is not quoted begins and ends with a comma, save at the
    ends of the record. Such a quote would also shift where records end.
    """
    parts = F.split(F.replace(text, F.lit('""'), F.lit("")), '"', -1)
    last = F.size(parts) - 1

    def fine(part: Column, i: Column) -> Column:
        opens = (i == 0) | part.startswith(",")
        closes = (i == last) | part.endswith(",")
        at_ends = (part == "") & ((i == 0) | (i == last))
        return (i % 2 == 1) | at_ends | (opens & closes)

    whole = F.aggregate(F.transform(parts, fine), F.lit(True), lambda all_, one: all_ & one)
    problem = F.concat(F.lit("a quote stands inside an unquoted value: "), F.left(text, F.lit(200)))
    return F.when(~F.contains(text, F.lit('"')) | whole, text).otherwise(F.raise_error(problem))


def csv_ranges(
    spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """path, start, end, inside: byte ranges of all files, and whether they begin inside quotes."""
    paths = [qualified(spark, p) for p in ([path] if isinstance(path, str) else path)]
    files = spark.read.format("binaryFile").load(paths).select("path", "length").where("length > 0")
    packed = files.where(F.rlike("path", F.lit(COMPRESSED))).head()
    if packed:
        raise ValueError(f"{packed.path}: compressed files cannot be cut into ranges")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    cut = files.select("path", "length", F.explode(starts).alias("start"))
    ranges = settle(cut.withColumn("end", F.least(F.col("start") + range_bytes, "length")), "ranges")
    # Nobody asks for the quotes of the last range of a file.
    counted = _spread(ranges.where("end < length").drop("length")).mapInArrow(
        _count_quotes, "path string, start long, quotes long"
    )
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    placed = ranges.join(counted, ["path", "start"], "left").select(
        "path", "start", "end", (quotes % 2 == 1).alias("inside")
    )
    return settle(placed, "ranges")


def read_csv_ranges(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    options: dict,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Rows of CSV files with a header row each, taken apart with the ``options`` of the reader.

    A record ends with a line feed outside quotes, with or without a carriage return before
    it. Empty lines are skipped. A row that does not fit the schema, a quote inside an
    unquoted value and one that is never closed are errors.
    """
    if range_bytes < 1:
        raise ValueError("range_bytes must be 1 or more")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = _spread(csv_ranges(spark, path, range_bytes)).mapInArrow(_cut, "record binary")
    text = F.rtrim(F.col("record").cast("string"), F.lit("\r\n"))
    texts = records.select(text.alias("text")).where("text != ''").select(_checked(F.col("text")).alias("text"))
    flags = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    flags |= {"header": "false", "mode": "FAILFAST", "multiLine": "true", "lineSep": "\n"}
    columns = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema]
    return texts.select(F.from_csv("text", ", ".join(columns), flags).alias("row")).select("row.*")
