"""DBF tables: read, write, catalog.

Python on the executors only moves bytes: the ``dbf_records`` data source hands
out and takes in whole fixed-width records as Arrow binary columns. Taking a
record apart and building one are column expressions, so unused fields are
never decoded and filters on the deletion flag run on the raw bytes.

The Arrow file systems are used for access, so paths may be local or shared
folders and ``hdfs://``, ``s3://`` or ``gs://`` addresses.
"""

from __future__ import annotations

import datetime
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from ledgerleaf.functions.names import check_unique, quoted
from ledgerleaf.scratch import qualified
from ledgerleaf.sources import manifest
from ledgerleaf.sources.dbf_layout import (
    DELETED_FLAG,
    END_OF_FILE,
    LIVE_FLAG,
    NAME_LENGTH,
    DbfField,
    header_bytes,
    list_dbf,
    open_path,
    read_header,
    record_length,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAILFAST = "FAILFAST"
PERMISSIVE = "PERMISSIVE"

SMALLEST_RANGE = 4 << 20
LARGEST_RANGE = 128 << 20
BATCH_BYTES = 4 << 20
FILE_BYTES = 128 << 20
LONGEST_TEXT = 254
DEFAULT_WIDTH = 10
OTHER_WIDTH = 50
WHITE_SPACE = "".join(chr(c) for c in range(256) if chr(c).isspace())


def _fields_json(fields) -> str:
    return json.dumps([asdict(f) for f in fields])


@dataclass
class _Piece:
    """Byte range of one file."""

    path: str
    start: int
    end: int


class _Pieces(InputPartition):
    def __init__(self, pieces: list[_Piece]) -> None:
        super().__init__(pieces)


class _Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]) -> None:
        self.files = files


class _RecordReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.permissive = options.get("mode", FAILFAST).upper() == PERMISSIVE
        self.fields = options["fields"]
        self.range_bytes = int(options["rangebytes"])

    def partitions(self) -> list[InputPartition]:
        """Large files are cut into ranges, small ones share a range."""
        parts: list[InputPartition] = []
        shared: list[_Piece] = []
        room = self.range_bytes
        for path, size in list_dbf(self.path):
            if size >= self.range_bytes:
                for start in range(0, size, self.range_bytes):
                    piece = _Piece(path, start, min(size, start + self.range_bytes))
                    parts.append(_Pieces([piece]))
                continue
            if size > room and shared:
                parts.append(_Pieces(shared))
                shared, room = [], self.range_bytes
            shared.append(_Piece(path, 0, size))
            room -= size
        if shared:
            parts.append(_Pieces(shared))
        return parts or [_Pieces([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = open_path(self.path)
        for piece in partition.value:
            yield from self._read_piece(system, piece)

    def _read_piece(self, system: fs.FileSystem, piece: _Piece) -> Iterator[pa.RecordBatch]:
        """Records that begin inside the range."""
        with system.open_input_file(piece.path) as file:
            header = read_header(file, self.permissive)
            if _fields_json(header.fields) != self.fields:
                raise ValueError(f"{piece.path} has other fields than the table")
            width = header.record_length
            stored = min(header.n_records, (file.size() - header.header_length) // width)
            if stored < header.n_records and not self.permissive:
                raise ValueError(
                    f"{piece.path} has {stored} whole records, its header says {header.n_records}"
                )
            first = max(0, -(-(piece.start - header.header_length) // width))
            last = min(stored, max(0, -(-(piece.end - header.header_length) // width)))
            step = max(1, BATCH_BYTES // width)
            file.seek(header.header_length + first * width)
            for at in range(first, last, step):
                count = min(step, last - at)
                data = file.read_buffer(count * width)
                records = pa.Array.from_buffers(pa.binary(width), count, [None, data])
                yield pa.RecordBatch.from_arrays([records.cast(pa.binary())], ["record"])


class _RecordWriter(DataSourceArrowWriter):
    """Every task writes whole files into the folder; a commit lists those that count.

    ``keepVersions`` earlier versions stay for readers that have begun.
    """

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.fields = [DbfField(**f) for f in json.loads(options["fields"])]
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        self.keep_versions = int(options.get("keepversions", 0))
        self.overwrite = overwrite
        self.mark = f"part-{uuid.uuid4().hex}-"
        # Until the commit, what is there now counts, and nothing of this write.
        system, target = open_path(self.path)
        system.create_dir(target, recursive=True)
        self.first = 0
        if manifest.current_files(system, target) is None:
            found = [(path[len(target) + 1 :], size) for path, size in list_dbf(self.path)]
            self.first = manifest.publish(system, target, found)

    def _store(self, body: list[bytes], count: int) -> tuple[str, int]:
        name = f"{self.mark}{uuid.uuid4().hex}.dbf"
        system, folder = open_path(self.path)
        pieces = [header_bytes(self.fields, count, datetime.date.today()), *body, END_OF_FILE]
        with system.open_output_stream(f"{folder}/{name}") as out:
            for piece in pieces:
                out.write(piece)
        return name, sum(len(piece) for piece in pieces)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        width = record_length(self.fields)
        limit = max(1, self.file_bytes // width)
        files: list[tuple[str, int]] = []
        body: list[bytes] = []
        held = 0
        for batch in iterator:
            column = batch.column(0).cast(pa.binary(width))
            at = 0
            while at < len(column):
                part = column.slice(at, limit - held)
                begin = part.offset * width
                data = part.buffers()[1]
                body.append(data.slice(begin, len(part) * width).to_pybytes())
                held += len(part)
                at += len(part)
                if held == limit:
                    files.append(self._store(body, held))
                    body, held = [], 0
        if held:
            files.append(self._store(body, held))
        return _Written(files)

    def _remove_own(self, but: set[str]) -> None:
        """Remove files of this write that no successful attempt has named."""
        system, target = open_path(self.path)
        entries = system.get_file_info(fs.FileSelector(target))
        own = [f.path for f in entries if f.base_name.startswith(self.mark)]
        manifest.remove(system, [path for path in own if path.rsplit("/", 1)[-1] not in but])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, target = open_path(self.path)
        files = [file for message in messages if message for file in message.files]
        if not files:
            files = [self._store([], 0)]
        before = [] if self.overwrite else manifest.current_files(system, target) or []
        number = manifest.publish(system, target, [*before, *files])
        manifest.remove_before(system, target, number - self.keep_versions)
        self._remove_own(but={name for name, _ in files})

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove_own(but=set())
        if self.first:
            system, target = open_path(self.path)
            manifest.withdraw(system, target, self.first)


class DbfRecords(DataSource):
    """Raw records of DBF files, one binary column ``record``."""

    @classmethod
    def name(cls) -> str:
        return "dbf_records"

    def schema(self) -> str:
        return "record binary"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _RecordReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _RecordWriter(dict(self.options), overwrite)


def spark_type(field: DbfField) -> T.DataType:
    """Column type of a field."""
    if field.type == "N" and field.decimals == 0:
        return T.LongType() if field.length <= 18 else T.DecimalType(min(field.length, 38), 0)
    if field.type in ("N", "F"):
        return T.DoubleType()
    return {"L": T.BooleanType(), "D": T.DateType()}.get(field.type, T.StringType())


def _text(field: DbfField, start: int) -> Column:
    """Trimmed text of a field, null when blank."""
    data = F.substring(F.col("record"), start, field.length)
    unpadded = F.trim(F.decode(data, "ISO-8859-1"))
    return F.nullif(F.btrim(unpadded, F.lit(WHITE_SPACE)), F.lit(""))


def _value(field: DbfField, mode: str) -> Column:
    """Typed value of a field's text."""
    text = quoted(field.name)
    if field.type in ("N", "F"):
        number = text.try_cast(spark_type(field))
        if mode == PERMISSIVE:
            return number
        problem = F.concat(F.lit(f"field {field.name}: not a number: "), text)
        return F.coalesce(number, F.when(text.isNotNull(), F.raise_error(problem)))
    if field.type == "L":
        return F.upper(text).isin("T", "Y", "1")
    if field.type == "D":
        eight_digits = F.rlike(text, F.lit(r"^\d{8}$"))
        return F.when(eight_digits, F.try_to_date(text, "yyyyMMdd"))
    return text


def read_dbf(
    spark: SparkSession,
    path: str,
    mode: str = FAILFAST,
    limit: int | None = None,
    range_bytes: int | None = None,
) -> DataFrame:
    """A DBF file, or all files below a folder, which must have the same fields.

    Deleted records are left out and blank fields are null. ``mode`` says what
    a value or file that cannot be read does: FAILFAST stops, PERMISSIVE
    gives null for a value, ends the fields at a bad descriptor, and ends a
    short file early. A task reads ``range_bytes``, by default as many as spread
    the files over all cores within sensible limits.
    """
    if mode not in (FAILFAST, PERMISSIVE):
        raise ValueError(f"mode must be {FAILFAST} or {PERMISSIVE}")
    path = qualified(spark, path)
    files = list_dbf(path)
    if not files:
        raise FileNotFoundError(f"no DBF files below {path}")
    system, _ = open_path(path)
    with system.open_input_stream(files[0][0]) as stream:
        header = read_header(stream, mode == PERMISSIVE)
    check_unique([f.name for f in header.fields])
    if range_bytes is None:
        share = sum(size for _, size in files) // spark.sparkContext.defaultParallelism
        range_bytes = min(LARGEST_RANGE, max(SMALLEST_RANGE, share))
    spark.dataSource.register(DbfRecords)
    records = (
        spark.read.format(DbfRecords.name())
        .options(mode=mode, fields=_fields_json(header.fields), rangeBytes=range_bytes)
        .load(path)
        .where(F.substring(F.col("record"), 1, 1) != F.lit(DELETED_FLAG))
    )
    texts, start = [], 2
    for field in header.fields:
        texts.append(_text(field, start).alias(field.name))
        start += field.length
    result = records.select(*texts).select(
        *[_value(field, mode).alias(field.name) for field in header.fields]
    )
    return result if limit is None else result.limit(limit)


def infer_fields(df: DataFrame, cut: bool = False) -> list[DbfField]:
    """Fields for the columns of ``df``; widths and digits take one pass over the data.

    Values that no field can hold as they are (texts above 254 characters) are an
    error unless ``cut``.
    """
    others = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType)
    texts = [f.name for f in df.schema if not isinstance(f.dataType, others)]
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    measures = [F.max(F.length(quoted(c).cast("string"))).alias(f"w_{c}") for c in texts]
    measures += [F.max(_fraction_digits(quoted(c))).alias(f"d_{c}") for c in floats]
    found = df.agg(*measures).first().asDict() if measures else {}
    fields = []
    for column in df.schema:
        kind = column.dataType
        if column.name in texts:
            least = DEFAULT_WIDTH if isinstance(kind, T.StringType) else OTHER_WIDTH
            width = found[f"w_{column.name}"] or least
            width = width if isinstance(kind, T.StringType) else max(width, least)
            if width > LONGEST_TEXT and not cut:
                raise ValueError(
                    f"column {column.name}: {width} characters, a field has {LONGEST_TEXT};"
                    " pass cut=True to shorten them"
                )
            field = DbfField(column.name, "C", min(width, LONGEST_TEXT))
        elif isinstance(kind, T.IntegralType):
            field = DbfField(column.name, "N", 18)
        elif isinstance(kind, T.DecimalType):
            field = DbfField(column.name, "N", kind.precision + 2, kind.scale)
        elif column.name in floats:
            field = DbfField(column.name, "F", 20, max(6, found[f"d_{column.name}"] or 0))
        elif isinstance(kind, T.BooleanType):
            field = DbfField(column.name, "L", 1)
        else:
            field = DbfField(column.name, "D", 8)
        fields.append(field)
    return fields


def _fraction_digits(number: Column) -> Column:
    """Digits behind the point that a number needs, 15 at most."""
    text = number.cast("double").try_cast("decimal(38,15)").cast("string")
    return F.length(F.regexp_extract(text, r"\.(\d*[1-9])?0*$", 1))


def max_widths(df: DataFrame, columns: list[str]) -> DataFrame:
    """Longest text per column, in characters: one row."""
    return df.agg(*[F.max(F.length(quoted(c))).alias(c) for c in columns])


def _fields_from_specs(df: DataFrame, specs: dict[str, dict]) -> list[DbfField]:
    missing = [c for c in df.columns if c not in specs]
    if missing:
        raise ValueError(f"no field specification for {missing}")
    return [
        DbfField(c, specs[c]["type"].upper(), specs[c]["length"], specs[c].get("decimal", 0))
        for c in df.columns
    ]


def _fitting(text: Column, field: DbfField) -> Column:
    """Right-aligned text; an error when it is wider than its field."""
    problem = F.concat(F.lit(f"field {field.name}: wider than {field.length}: "), text)
    return (
        F.when(text.isNull(), F.lit(" " * field.length))
        .when(F.length(text) <= field.length, F.lpad(text, field.length, " "))
        .otherwise(F.raise_error(problem))
    )


def _encoded(value: Column, kind: T.DataType, field: DbfField, cut: bool) -> Column:
    blank = F.lit(" " * field.length)
    if field.type in ("N", "F"):
        if field.type == "N" and field.decimals == 0:
            whole = value if isinstance(kind, T.IntegralType) else value.try_cast("bigint")
            return _fitting(whole.cast("string"), field)
        number = value.try_cast("double")
        special = (
            F.when(F.isnan(number), "nan")
            .when(number == float("inf"), "inf")
            .when(number == float("-inf"), "-inf")
        )
        digits = number.try_cast(f"decimal(38,{field.decimals})").cast("string")
        plain = F.coalesce(digits, F.format_string(f"%.{field.decimals}f", number))
        if not cut:
            problem = F.concat(
                F.lit(f"field {field.name}: more than {field.decimals} decimals: "),
                number.cast("string"),
            )
            changed = plain.cast("double") != number
            plain = F.when(changed, F.raise_error(problem)).otherwise(plain)
        text = F.when(number.isNull(), None).otherwise(F.coalesce(special, plain))
        return _fitting(text, field)
    if field.type == "L":
        flag = F.when(value.cast("boolean"), "T").otherwise("F")
        return F.rpad(F.when(value.isNotNull(), flag).otherwise(" "), field.length, " ")
    if field.type == "D":
        if not isinstance(kind, T.DateType):
            return blank
        return F.rpad(F.coalesce(F.date_format(value, "yyyyMMdd"), blank), field.length, " ")
    text = value.cast("string")
    if cut:
        text = F.regexp_replace(text, r"[^\x00-\xFF]", "?")
    else:
        problem = F.concat(F.lit(f"field {field.name}: wider than {field.length}: "), text)
        text = F.when(F.length(text) > field.length, F.raise_error(problem)).otherwise(text)
    return F.rpad(F.coalesce(text, blank), field.length, " ")


def encode_records(
    df: DataFrame, fields: list[DbfField], deleted: Column | None = None, cut: bool = False
) -> DataFrame:
    """One binary ``record`` per row; ``deleted`` rows are flagged as such.

    Texts are stored as Latin-1. A value that its field cannot hold is an error;
    with ``cut`` texts are shortened, other characters become ``?`` and numbers
    are rounded.
    """
    flag = F.lit(LIVE_FLAG.decode())
    if deleted is not None:
        flag = F.when(deleted, DELETED_FLAG.decode()).otherwise(flag)
    parts = [
        _encoded(quoted(column.name), column.dataType, field, cut)
        for column, field in zip(df.schema, fields, strict=True)
    ]
    return df.select(F.encode(F.concat(flag, *parts), "ISO-8859-1").alias("record"))


def write_records(
    records: DataFrame, fields: list[DbfField], path: str, keep_versions: int = 0
) -> None:
    """Replace the DBF files below ``path`` by the given records.

    Readers see the old files until the write ends, then the new ones. Old files are removed
    then, but for those of the last ``keep_versions`` writes, which jobs that are
    reading them need.
    """
    short = [replace(f, name=f.name[:NAME_LENGTH]) for f in fields]
    check_unique([f.name for f in short])
    spark = records.sparkSession
    spark.dataSource.register(DbfRecords)
    records.write.format(DbfRecords.name()).mode("overwrite").options(
        fields=_fields_json(short), keepVersions=keep_versions
    ).save(qualified(spark, path))


def write_dbf(
    df: DataFrame,
    path: str,
    specs: dict[str, dict] | None = None,
    cut: bool | None = None,
    keep_versions: int = 0,
) -> None:
    """Write ``df`` as a folder of DBF files, replacing those already there.

    ``specs`` gives type, length and decimal per column; otherwise they are
    inferred. Names are cut to 10 characters. Values that do not fit their field
    are an error; with ``cut``, and by default with given ``specs``, texts are cut
    to their field and numbers rounded to its decimals. Without rows, one file
    with only a header is written. ``keep_versions`` is that of :func:`write_records`.
    """
    cut = specs is not None if cut is None else cut
    fields = infer_fields(df, cut) if specs is None else _fields_from_specs(df, specs)
    write_records(encode_records(df, fields, cut=cut), fields, path, keep_versions)


_CATALOG_SCHEMA = """
    path string, file_exists boolean, file_size bigint, index_exists boolean, index_size bigint,
    record_count bigint, field_no int, field_name string, field_type string,
    field_length int, field_decimals int, error string
"""


def _catalog_rows(path: str) -> list[dict]:
    system, inner = open_path(path)
    index = inner.rsplit(".", 1)[0] + ".cdx"
    file_info, index_info = system.get_file_info([inner, index])
    row = {
        "path": path,
        "file_exists": file_info.type == fs.FileType.File,
        "file_size": file_info.size or 0,
        "index_exists": index_info.type == fs.FileType.File,
        "index_size": index_info.size or 0,
    }
    try:
        with system.open_input_stream(inner) as stream:
            header = read_header(stream)
    except (OSError, ValueError) as problem:
        return [{**row, "error": str(problem)}]
    return [
        {
            **row,
            "record_count": header.n_records,
            "field_no": number,
            "field_name": field.name,
            "field_type": field.type,
            "field_length": field.length,
            "field_decimals": field.decimals,
        }
        for number, field in enumerate(header.fields, start=1)
    ]


def _catalog_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [line.split()[0] for line in _CATALOG_SCHEMA.replace("\n", " ").split(",")]
    for batch in batches:
        rows = [row for path in batch["path"] for row in _catalog_rows(path)]
        table = pd.DataFrame(rows, columns=columns, dtype=object)
        yield table.where(table.notna(), None)


def dbf_catalog(spark: SparkSession, where: str | list[str], tasks: int | None = None) -> DataFrame:
    """One row per file and field, from the headers alone.

    ``where`` is a path pattern, listed by Spark, or a list of files. A file that
    is missing or cannot be read has one row with the reason in ``error``.
    """
    if isinstance(where, str):
        files = (
            spark.read.format("binaryFile")
            .options(pathGlobFilter="*.{dbf,DBF}", recursiveFileLookup=True)
            .load(where)
            .select("path")
        )
    else:
        files = spark.createDataFrame([(p,) for p in where], "path string")
    tasks = tasks or spark.sparkContext.defaultParallelism
    return files.repartition(tasks, "path").mapInPandas(_catalog_batches, _CATALOG_SCHEMA)
