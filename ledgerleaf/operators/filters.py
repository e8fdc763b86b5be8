"""Row filters."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf.functions.names import quoted


def slice_filter(conditions: dict[str, Any]) -> Column:
    """All columns equal their given values; no conditions keep every row."""
    tests = [quoted(name) == F.lit(value) for name, value in conditions.items()]
    return reduce(and_, tests, F.lit(True))


def differs_or_missing(column: Column, value: Any) -> Column:
    """``column != value``, also true where the column is null."""
    return ~column.eqNullSafe(F.lit(value))


def is_stochastic(scenario: Column, last: int = 1000) -> Column:
    """Scenario numbers 1 to ``last``; 0 is deterministic, -1 the single equivalent."""
    return scenario.between(1, last)


def name_excluded(name: Column, pattern: str) -> Column:
    """Name matches the regular expression anywhere, in any letter case."""
    return F.rlike(name, F.lit("(?i)" + pattern))


def has_content(text: Column) -> Column:
    """At least one line; false for a null."""
    return F.coalesce(F.length(text) > 0, F.lit(False))
