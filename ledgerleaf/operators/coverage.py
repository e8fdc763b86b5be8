"""Do the combinations in use all have an entry in the assumption table?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.keys import combo_key
from ledgerleaf.functions.names import require_columns


def combos(df: DataFrame, columns: list[str], sep: str = "|") -> DataFrame:
    """One ``combo`` text per row."""
    require_columns(df, columns)
    return df.select(combo_key(columns, sep).alias("combo"))


def missing_combos(used: DataFrame, defined: DataFrame) -> DataFrame:
    """Distinct combinations of ``used`` that ``defined`` lacks."""
    return used.distinct().join(defined.distinct(), "combo", "left_anti")


def covers_all(used: DataFrame, defined: DataFrame) -> DataFrame:
    """One row: is every combination of ``used`` in ``defined``?"""
    return missing_combos(used, defined).agg((F.count(F.lit(1)) == 0).alias("covered"))


def _group_combos(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Distinct combinations of all groups, from one pass over the rows."""
    for tags in groups.values():
        require_columns(df, tags)
    entries = [
        F.struct(F.lit(group).alias("assumption_group"), combo_key(tags).alias("combo"))
        for group, tags in groups.items()
    ]
    return df.select(F.inline(F.array(*entries))).distinct()


def check_coverage(used: DataFrame, defined: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Missing combinations per assumption group; no rows when all are covered."""
    if not groups:
        raise ValueError("no assumption groups given")
    return _group_combos(used, groups).join(
        _group_combos(defined, groups), ["assumption_group", "combo"], "left_anti"
    )
