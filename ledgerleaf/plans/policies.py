"""Per-policy attributes from small fixed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators.mapping import literal_map

# Administration system by policy key.
ADMIN_SYSTEMS = {"aaa": "flex", "bbb": "mips", "ccc": "schd"}


def policy_stat_code(lpolicy_id: Column) -> Column:
    return F.when(lpolicy_id == "aaa", "CSO80").otherwise("CET80")


def add_policy_info(policies: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``stat_code`` and ``system``. Strict: an unknown policy key is an error."""
    return policies.select(
        "*",
        policy_stat_code(F.col("lpolicy_id")).alias("stat_code"),
        literal_map(F.col("policy_id"), ADMIN_SYSTEMS, strict).alias("system"),
    )
