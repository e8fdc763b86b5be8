"""Text keys made of several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf.functions.names import quoted


def key_part(name: str) -> Column:
    """Text of one key column; a missing value reads ``nan``."""
    return F.coalesce(quoted(name).cast("string"), F.lit("nan"))


def combo_key(columns: list[str], sep: str = "|") -> Column:
    """The columns joined by ``sep``. No value is skipped, so parts never shift."""
    if not columns:
        raise ValueError("a combination needs at least one column")
    return F.concat_ws(sep, *[key_part(c) for c in columns])
