"""Small helpers of the corpus operators."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.scratch import settle

KELVIN_SIGN = "\u212a"
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[ \t-\r]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_latin(text: Column) -> Column:
    """A-Z in lower case, for comparing with ASCII words.

    The Kelvin sign is the one other character whose lower case is an ASCII
    letter. It becomes a character that no ASCII word holds. Other letters may
    change, but only to other non-ASCII letters.
    """
    return F.lower(F.replace(text, F.lit(KELVIN_SIGN), F.lit("\ufffd")))


def lower_az(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than blank and U+0009 to U+000D."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, BLANK_RUN)
    )


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def by_size(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of text or numbers, one row at least."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        if pa.types.is_list(values.type):
            lengths = pc.multiply(pc.list_value_length(values), 4).to_pylist()
        else:
            lengths = pc.binary_length(values).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + (n or 0) > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def plain_names(docs: DataFrame, keep: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``keep`` named by number, and what gives them back.

    Steps may then add columns of any other name.
    """
    names = [c if c in keep else f"c{i}" for i, c in enumerate(docs.columns)]
    back = [F.col(name).alias(c) for name, c in zip(names, docs.columns, strict=True)]
    return docs.toDF(*names), back


def own_rows(docs: DataFrame, key: str, text: str, share: bool) -> tuple[DataFrame, bool]:
    """``docs`` with a column ``_row`` that tells its rows apart, and whether it is not just the key.

    Where every row has a key of its own, that is ``_row``. Else rows are numbered
    once, by key and text, null keys last, and stored. With ``share``, rows of equal
    key and text have the least of their numbers; rows without a key never do.
    """
    ids = docs.select(F.col(key).cast("long").alias("id"))
    odd = ids.groupBy("id").agg(F.count("*").alias("n")).where("id is null or n > 1")
    if odd.isEmpty():
        return docs.withColumn("_row", F.col(key).cast("long")), False
    whole = F.col(text).cast("string")
    names = ("_id", "_h1", "_h2")
    marks = [F.col(key).cast("long"), F.xxhash64(whole), F.xxhash64(F.lit(1), whole)]
    marked = docs.select("*", *[m.alias(n) for m, n in zip(marks, names, strict=True)])
    ordered = marked.orderBy(F.col("_id").asc_nulls_last(), "_h1", "_h2")
    rows = settle(ordered.withColumn("_row", F.monotonically_increasing_id()), "rows")
    if share:
        firsts = (
            rows.where("_id is not null")
            .groupBy(*names)
            .agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
            .where("_n > 1")
            .drop("_n")
        )
        own = F.coalesce("_first", "_row")
        rows = rows.join(firsts, list(names), "left").withColumn("_row", own).drop("_first")
    return rows.select(*docs.columns, "_row"), True
