"""Tables and query texts."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.functions.names import quoted
from ledgerleaf.operators.filters import slice_filter


def read_table(
    spark: SparkSession,
    name: str,
    columns: list[str] | None = None,
    where: dict[str, Any] | None = None,
) -> DataFrame:
    """A catalog table or view; columns and conditions reach the scan."""
    df = spark.table(name).where(slice_filter(where or {}))
    return df if columns is None else df.select(*[quoted(c) for c in columns])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    where: dict[str, Any] | None = None,
    split_by: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A table or query of an external database.

    ``split_by`` is (whole-number column, lowest, highest, number of parts):
    parts are then read side by side. It needs ``table``.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if query is not None:
        if split_by is not None:
            raise ValueError("a query cannot be read in parts, use a table")
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
    if split_by is not None:
        column, low, high, parts = split_by
        reader = reader.options(
            partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts
        )
    return reader.load().where(slice_filter(where or {}))


def run_query_text(spark: SparkSession, text: str, args: dict[str, Any] | None = None) -> DataFrame:
    """Result of one SQL statement; ``:name`` stands for a value of ``args``.

    Table names are passed as values too: ``FROM IDENTIFIER(:cash_flows)``.
    """
    return spark.sql(text, args=args or {})


def run_query_file(spark: SparkSession, path: str, args: dict[str, Any] | None = None) -> DataFrame:
    """:func:`run_query_text` for a statement kept in a file."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return run_query_text(spark, text, args)
