"""CSV files and bulk loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.sources.csv_ranges import RANGE_BYTES as RANGE_BYTES
from ledgerleaf.sources.csv_ranges import read_csv_ranges

# Blanks at the ends, empty texts and fractions of a second have to come back as
# they are. Null is an empty field, an empty text a pair of quotes.
_FORMAT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
# What an empty field stands for while reading: a text that files do not hold.
_NO_VALUE = "\x00"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema=None,
    quoted_newlines: bool = True,
    range_bytes: int | None = None,
) -> DataFrame:
    """CSV with a header row.

    Values may hold line breaks inside quotes. Each such file is one task, unless
    ``range_bytes`` cuts it into ranges of that size, which takes a ``schema`` and
    strict quoting (see ``csv_ranges``). Pass ``quoted_newlines=False`` for
    files that have no such breaks; with a ``schema``, a row that does not fit it
    is an error then. Without a ``schema`` the types are inferred, which reads the
    data once more. An empty field is null, a pair of quotes an empty text.
    """
    if range_bytes is not None:
        if schema is None or not quoted_newlines:
            raise ValueError("range_bytes takes a schema, and is for files with quoted_newlines")
        options = {**_FORMAT, "nullValue": _NO_VALUE, "emptyValue": ""}
        return read_csv_ranges(spark, path, schema, options, range_bytes)
    reader = spark.read.options(
        **_FORMAT, multiLine=quoted_newlines, nullValue=_NO_VALUE, emptyValue=""
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    reader = reader.schema(schema)
    if not quoted_newlines:
        reader = reader.option("mode", "FAILFAST")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace ``path`` by CSV files with a header row; :func:`read_csv` gives the same values."""
    df.write.mode("overwrite").options(**_FORMAT, nullValue="", emptyValue='""').csv(path)


def csv_to_table(
    spark: SparkSession,
    csv_path: str | list[str],
    table: str,
    schema=None,
    path: str | None = None,
    quoted_newlines: bool = True,
    range_bytes: int | None = None,
) -> DataFrame:
    """Append the rows of a CSV file to a table, which is created when absent.

    A table that exists keeps its types. ``path`` makes it an external table in
    that folder. For ``quoted_newlines`` and ``range_bytes`` see :func:`read_csv`.
    """
    if schema is None and spark.catalog.tableExists(table):
        schema = spark.table(table).schema
    rows = read_csv(spark, csv_path, schema, quoted_newlines, range_bytes)
    writer = rows.write.mode("append").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)
