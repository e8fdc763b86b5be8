"""Sums of doubles that do not depend on the order of rows.

A double is a whole number times a power of two. It is cut into three limbs on a fixed
grid of places, 26 bits apart; limbs of a place are whole numbers, so adding them is exact
and partial sums combine in any order. Only the total of all places is rounded, once, to
the nearest double. Limbs are added by hash aggregation with partial sums in each task;
what is shuffled is one number for each group, column, place and part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.functions.names import check_unique, quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 26
# Power of two of the least double, which is place 0.
LOWEST = -1074
PLACES = (1023 - LOWEST) // BITS + 1
NOT_A_NUMBER, INFINITE, MINUS_INFINITE = -1, -2, -3
LIMBS = 3
# Limbs of a group are added in so many parts: 2**63 / 2**26 values fit in each.
PARTS = 64

_powers = [2.0 ** (BITS * place + LOWEST) for place in range(PLACES)]


def _power(place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in _powers]), place + 1)


def _place(size: Column) -> Column:
    """Highest place of a number above 0; the logarithm may be off by one place at a border."""
    near = F.greatest(F.floor((F.log2(size) - LOWEST) / BITS).cast("int"), F.lit(0))
    return F.least(near, F.lit(PLACES - 1))


def _with_limbs(values: DataFrame) -> DataFrame:
    """``place`` of the highest limb of ``value``, and the limbs of it and the two places below."""
    value, size, place = F.col("value"), F.abs("value"), F.col("place")
    near = values.withColumn(
        "near",
        F.when(F.isnan(value), NOT_A_NUMBER)
        .when(value == float("inf"), INFINITE)
        .when(value == float("-inf"), MINUS_INFINITE)
        .when(value == 0, 0)
        .otherwise(_place(size)),
    )
    over = (F.col("near") > 0) & (size < _power(F.col("near")))
    rows = near.withColumn("place", F.when(over, F.col("near") - 1).otherwise(F.col("near")))
    plain = place >= 0
    rows = rows.withColumn("rest", F.when(plain, value).otherwise(F.lit(0.0)))
    for step in range(LIMBS):
        power = _power(F.greatest(place - step, F.lit(0)))
        limb = F.col(f"limb{step}")
        rows = rows.withColumn(f"limb{step}", (F.col("rest") / power).cast("long"))
        rows = rows.withColumn("rest", F.col("rest") - limb * power)
    # What is no number is only counted.
    return rows.withColumn("limb0", F.when(plain, F.col("limb0")).otherwise(1))


def _rounded(totals: dict[int, int]) -> float:
    """The double nearest to the number that the totals of all places make."""
    up, down = totals.pop(INFINITE, 0), totals.pop(MINUS_INFINITE, 0)
    if totals.pop(NOT_A_NUMBER, 0) or up and down:
        return float("nan")
    if up or down:
        return float("inf") if up else float("-inf")
    whole = sum(total << (BITS * place) for place, total in totals.items())
    try:
        return whole / (1 << -LOWEST)
    except OverflowError:
        return float("inf") if whole > 0 else float("-inf")


def exact_sums(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per group: ``keys`` and the sums of ``columns`` (numbers, taken as doubles).

    Missing values are skipped; a sum without any is null. Null keys are a group. Sums
    with NaN, or with both infinities, are NaN; beyond the largest double they are
    infinite; a sum of zeros is 0. Without rows there are no groups; without ``keys`` all
    rows are one. Other columns are ignored, whatever their names.
    """
    check_unique([*keys, *columns])
    if not columns:
        raise ValueError("name at least one column")
    own = [f"key{i}" for i in range(len(keys))]

    def numbered(number: int, value: Column) -> Column:
        return F.struct(F.lit(number).alias("number"), value.cast("double").alias("value"))

    # A row for each value, and one that tells the group.
    entries = [numbered(-1, F.lit(0.0)), *[numbered(i, quoted(c)) for i, c in enumerate(columns)]]
    values = df.select(
        *[quoted(key).alias(name) for key, name in zip(keys, own, strict=True)],
        F.inline(F.array(*entries)),
    ).where("value is not null")
    limbs = [f"limb{step}" for step in range(LIMBS)]
    added = (
        _with_limbs(values)
        .withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
        .groupBy(*own, "number", "place", "part")
        .agg(*[F.sum(limb).alias(limb) for limb in limbs])
    )
    # At most one entry for each column, place and part.
    entry_names = ["number", "place", *limbs]
    gathered = added.groupBy(*own).agg(F.collect_list(F.struct(*entry_names)).alias("entries"))
    width = len(columns)

    def round_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for entries in batch.column("entries").to_pylist():
                totals: list[dict[int, int]] = [{} for _ in range(width)]
                for entry in entries:
                    number, place, *parts = (entry[name] for name in entry_names)
                    if number >= 0:
                        total = totals[number]
                        for step, limb in enumerate(parts):
                            if limb or not step:
                                total[place - step] = total.get(place - step, 0) + limb
                sums.append([_rounded(t) if t else None for t in totals])
            arrays = [batch.column(name) for name in own]
            arrays.append(pa.array(sums, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(arrays, [*own, "sums"])

    schema = T.StructType([*gathered.select(*own).schema, T.StructField("sums", T.ArrayType(T.DoubleType()))])
    summed = gathered.mapInArrow(round_once, schema)
    return summed.select(
        *[F.col(name).alias(key) for key, name in zip(keys, own, strict=True)],
        *[F.get("sums", F.lit(i)).alias(c) for i, c in enumerate(columns)],
    )
