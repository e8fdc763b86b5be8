"""Latest lien amount per policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.text import LINE_BREAK, is_lien_line, lien_amount


def latest_lien(notes: DataFrame, policy: str = "policy_id", text: str = "text") -> DataFrame:
    """Amount of the last lien line of each note, 0 without one. No shuffle."""
    lines = F.split(F.col(text), LINE_BREAK)
    last = F.try_element_at(F.filter(lines, is_lien_line), F.lit(-1))
    amount = F.when(last.isNull(), F.lit(0.0)).otherwise(lien_amount(last))
    return notes.select(policy, amount.alias("lien_amount"))


def latest_lien_of_lines(
    lines: DataFrame, policy: str = "policy_id", order: str = "line_no", line: str = "line"
) -> DataFrame:
    """The same for notes stored as one row per line, of any number per policy.

    Amounts are read before the aggregation, so that it holds numbers only and
    can hash instead of sort.
    """
    position = F.when(is_lien_line(F.col(line)), F.col(order))
    amount = F.when(position.isNotNull(), lien_amount(F.col(line)))
    return (
        lines.select(policy, position.alias("_position"), amount.alias("_amount"))
        .groupBy(policy)
        .agg(F.max_by("_amount", "_position").alias("_last"), F.max("_position").alias("_position"))
        .select(
            policy,
            F.when(F.col("_position").isNull(), F.lit(0.0)).otherwise(F.col("_last")).alias("lien_amount"),
        )
    )
