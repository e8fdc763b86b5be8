"""Stages that turn raw documents into training data, each over all rows of the one before.

Each stage takes the session, the documents that the stage before kept and the
folder of the tables. All but the last return the columns of the documents. The result
of a stage is to be written before the next one starts, which then removes the tables
that this stage has left in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from ledgerleaf.scratch import noted_tables, reads_any, remove_tables, settle

TOKENIZER = "word_bpe_49k.json"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Paths of the tables that the last stage of an application has left.
_left: dict[str, list[str]] = {}


def _clearing(stage: Stage) -> Stage:
    """``stage``, after the tables of the stage before are removed, unless it reads them."""

    @wraps(stage)
    def cleared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        before = _left.pop(application, [])
        if reads_any(docs, before):
            kept = before
        else:
            kept = []
            remove_tables(spark, before)
        with noted_tables() as paths:
            result = stage(spark, docs, sf_dir)
        _left[application] = [*kept, *paths]
        return result

    return cleared


@_clearing
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


@_clearing
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one; ``n_chars`` follows the text."""
    cut = line_dedup.dedup_lines(docs)
    if "n_chars" not in cut.columns:
        return cut
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


@_clearing
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


@_clearing
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_clearing
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and the digest of what the ids decode to."""
    path = public_tokenizers.path(TOKENIZER)
    return bpe.bpe_decode(bpe.bpe_encode(docs, path), path).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", token_stage),
]

# Similarity joins, alignments and encoding cannot be expressed in SQL over all rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again.

    Of the results, only that of the last stage but one stays, which the rows are read from.
    """
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read: list[str] = []
    for name, stage in STAGES[:-1]:
        result = stage(spark, rows, sf_dir)
        with noted_tables() as written:
            rows = settle(result, name)
        remove_tables(spark, read)
        read = written
    return STAGES[-1][1](spark, rows, sf_dir)
