"""Which modules of a new snapshot differ from the old one?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.operators.filters import has_content, name_excluded
from ledgerleaf.scratch import settle


def read_modules(spark: SparkSession, path: str, names: str = "*.{vb,bas,cls}") -> DataFrame:
    """Module files below a folder: name without extension, path, text."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", names)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    file_name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_replace(file_name, r"\.[^.]*$", "").alias("name"),
        "path",
        F.decode("content", "ISO-8859-1").alias("text"),
    )


def _digests(modules: DataFrame) -> DataFrame:
    return modules.select("name", F.md5(F.col("text").cast("binary")).alias("digest"))


def snapshot_diff(
    old: DataFrame, new: DataFrame, force: bool = False, exclude: str | None = None
) -> DataFrame:
    """Status of every exported module of ``new``.

    New: not in ``old``. Unchanged: same digest. Otherwise Changed if changes
    are forced, else Conflict. Empty modules and names matching ``exclude``
    are left out. Only names and digests are shuffled, never texts.
    """
    exported = new.where(has_content(F.col("text")))
    if exclude:
        exported = exported.where(~name_excluded(F.col("name"), exclude))
    old_digest = _digests(old).withColumnRenamed("digest", "old_digest")
    status = (
        F.when(F.col("old_digest").isNull(), "New")
        .when(F.col("old_digest") == F.col("digest"), "Unchanged")
        .otherwise("Changed" if force else "Conflict")
    )
    return (
        _digests(exported)
        .join(old_digest, "name", "left")
        .select("name", status.alias("status"), "digest", "old_digest")
    )


def merge_snapshot(old: DataFrame, new: DataFrame, diff: DataFrame) -> DataFrame:
    """The stored modules after the export: New and Changed ones are replaced."""
    written = settle(diff.where(F.col("status").isin("New", "Changed")).select("name"), "written")
    fresh = new.select("name", "text").join(written, "name", "left_semi")
    kept = old.select("name", "text").join(written, "name", "left_anti")
    return kept.unionByName(fresh)
