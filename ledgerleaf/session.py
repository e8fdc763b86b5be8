"""Spark sessions with the settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter at any size. Sizes of machines and the number of shuffle
# partitions belong to the cluster and are not set here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cores: int | str = "*", memory: str = "8g", checkpoint_dir: str | None = None
) -> SparkSession:
    """Session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerleaf")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
