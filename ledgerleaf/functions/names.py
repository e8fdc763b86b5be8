"""Column-name rules: standard names and quoting."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by its literal name, also when it holds dots, spaces or slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def standard_name(name: str) -> str:
    """Lower case; runs of anything but ``[0-9a-z_]`` become one underscore."""
    words = re.sub(r"[^0-9a-z_\s]", " ", name.lower()).split()
    return "_".join(words)


def standard_name_of(value: Column) -> Column:
    """:func:`standard_name` for the values of a string column."""
    spaced = F.regexp_replace(F.lower(value), r"[^0-9a-z_]+", " ")
    return F.replace(F.trim(spaced), F.lit(" "), F.lit("_"))


def check_unique(names: list[str]) -> None:
    repeated = sorted(n for n, times in Counter(names).items() if times > 1)
    if repeated:
        raise ValueError(f"columns would collide: {repeated}")


def standardize_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Apply ``renames``, then give every column its standard name.

    Raises when two columns would end up with the same name.
    """
    renames = renames or {}
    names = [standard_name(renames.get(c, c)) for c in df.columns]
    check_unique(names)
    return df.toDF(*names)


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise unless ``df`` has all ``columns``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found in {df.columns}")


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]
