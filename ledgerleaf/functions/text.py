"""Text functions: lien amounts and common subsequences."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get the functions of this module with the plan, not by import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# How a lien line is recognised and where its cumulative amount stands.
LIEN_WORD = "LIEN"
LIEN_PATTERN = r"LTCC:.*\$(.*)\(C\).*LIEN"
LINE_BREAK = r"\r\n|\r|\n"

# Subsequences of texts up to this product of lengths come from one table of bit rows.
SMALL_TABLE = 1 << 22


def is_lien_line(line: Column) -> Column:
    return line.contains(LIEN_WORD)


def lien_amount(line: Column) -> Column:
    """Cumulative amount of a lien line.

    0 when the line has another form, null when its amount is not a number.
    """
    digits = F.replace(F.regexp_extract(line, LIEN_PATTERN, 1), F.lit(","), F.lit(""))
    matched = F.rlike(line, F.lit(LIEN_PATTERN))
    return F.when(matched, F.trim(digits).try_cast("double")).otherwise(F.lit(0.0))


def _places_of(text: str) -> dict[str, int]:
    """Bits of the places of each letter."""
    places: dict[str, int] = {}
    for j, char in enumerate(text):
        places[char] = places.get(char, 0) | (1 << j)
    return places


def _last_row(chars: str, other: str) -> int:
    """Bit row of the subsequence table after all of ``chars``.

    Its zero bits below j count the longest common subsequence with the first j
    characters of ``other``.
    """
    places = _places_of(other)
    full = (1 << len(other)) - 1
    row = full
    for char in chars:
        hits = row & places.get(char, 0)
        row = ((row + hits) | (row - hits)) & full
    return row


def subsequence_length(left: str, right: str) -> int:
    return len(right) - _last_row(left, right).bit_count()


def _zeros_up_to(row: int, width: int) -> np.ndarray:
    """How many zero bits lie below each place from 0 to ``width``."""
    held = np.frombuffer(row.to_bytes(width // 8 + 1, "little"), dtype=np.uint8)
    ones = np.unpackbits(held, bitorder="little", count=width)
    return np.append(0, np.cumsum(1 - ones.astype(np.int64)))


def _small_subsequence(left: str, right: str) -> str:
    """The subsequence from all bit rows at once, for a few characters of ``left``."""
    places = _places_of(right)
    full = (1 << len(right)) - 1
    rows = [full]
    for char in left:
        hits = rows[-1] & places.get(char, 0)
        rows.append(((rows[-1] + hits) | (rows[-1] - hits)) & full)
    i, j = len(left), len(right)
    taken = []
    while i and j:
        if left[i - 1] == right[j - 1]:
            taken.append(left[i - 1])
            i, j = i - 1, j - 1
            continue
        below = (1 << j) - 1
        without_right = (j - 1) - (rows[i] & (below >> 1)).bit_count()
        without_left = j - (rows[i - 1] & below).bit_count()
        if without_right > without_left:
            j -= 1
        else:
            i -= 1
    return "".join(reversed(taken))


def _subsequence(left: str, right: str) -> str:
    """The same subsequence as by the whole table, in the space of two bit rows.

    ``left`` is halved: the path that drops the end of ``left`` first crosses the middle
    where the lengths of both halves add up to the whole, as far right as that holds.
    """
    parts: list[str] = []
    todo = [(left, right)]
    while todo:
        left, right = todo.pop()
        if not left or not right:
            continue
        if len(left) * len(right) <= SMALL_TABLE:
            parts.append(_small_subsequence(left, right))
            continue
        if len(left) == 1:
            parts.append(left if left in right else "")
            continue
        half = len(left) // 2
        front = _zeros_up_to(_last_row(left[:half], right), len(right))
        back = _zeros_up_to(_last_row(left[half:][::-1], right[::-1]), len(right))[::-1]
        both = front + back
        cut = int(np.flatnonzero(both == both.max())[-1])
        todo.append((left[half:], right[cut:]))
        todo.append((left[:half], right[:cut]))
        # The first half is taken up next, so parts come in order.
    return "".join(parts)


@F.pandas_udf(T.IntegerType())
def _lcs_length(left: pd.Series, right: pd.Series) -> pd.Series:
    pairs = zip(left, right, strict=True)
    return pd.Series(
        [None if a is None or b is None else subsequence_length(a, b) for a, b in pairs], dtype="Int32"
    )


@F.pandas_udf(T.StringType())
def _lcs_text(left: pd.Series, right: pd.Series) -> pd.Series:
    pairs = zip(left, right, strict=True)
    return pd.Series(
        [None if a is None or b is None else _subsequence(a, b) for a, b in pairs], dtype=object
    )


def lcs_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence of two texts.

    Spark has no such function; batches go through Arrow and each table row is
    one big integer, so cost grows with ``len(left) * len(right) / 64``.
    """
    return _lcs_length(left, right)


def lcs_text(left: Column, right: Column) -> Column:
    """The longest common subsequence itself.

    Where several are equally long, the end of ``left`` is dropped first.
    """
    return _lcs_text(left, right)
