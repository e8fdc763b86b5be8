"""Running totals that hold up when one group has most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.functions.names import check_unique, quoted
from ledgerleaf.scratch import settle

_OWN = ("_value", "_copies", "_block", "_inside", "_before", "_total", "_copy", "_from")
COPIES_PER_TASK = 100_000
# Rows that a task counts or adds up; by their bytes, which are few, many more would meet in one.
ROWS_PER_TASK = 250_000


def row_tasks(df: DataFrame) -> int:
    """Tasks for the rows of a stored table, of ``ROWS_PER_TASK`` each."""
    return -(-max(1, df.count()) // ROWS_PER_TASK)


def repeat_rows(df: DataFrame, copies: str, index: str, most: int) -> DataFrame:
    """Each row ``copies`` times, numbered from 0 in ``index``; a row with 0 copies is left out.

    ``most`` is the largest number of copies. A row with very many is first cut
    into runs of ``COPIES_PER_TASK`` that are spread over all tasks.
    """
    amount = quoted(copies)
    zero = F.lit(0).cast("bigint")
    if most <= COPIES_PER_TASK:
        return df.where(amount > 0).withColumn(index, F.explode(F.sequence(zero, amount - 1)))
    few = repeat_rows(df.where(amount <= COPIES_PER_TASK), copies, index, COPIES_PER_TASK)
    run_length = F.lit(COPIES_PER_TASK).cast("bigint")
    runs = df.where(amount > COPIES_PER_TASK).withColumn(
        "_from", F.explode(F.sequence(zero, amount - 1, run_length))
    )
    last = F.least(F.col("_from") + run_length, amount) - 1
    many = (
        runs.repartition(*[quoted(c) for c in df.columns], F.col("_from"))
        .withColumn(index, F.explode(F.sequence(F.col("_from"), last)))
        .drop("_from")
    )
    return few.unionByName(many)


def largest(df: DataFrame, column: str) -> int:
    """Largest value of a whole-number column of a stored table; 0 without rows."""
    return df.agg(F.max(quoted(column))).first()[0] or 0


def running_total_before(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    out: str,
    blocks: int | None = None,
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, 0 for the first.

    Rows that tie on ``order`` are put in order of their other columns; nulls
    come last. A group may be of any size, whatever its order values: equal rows
    are counted before the first shuffle, the rest is cut by range into parts of
    about the same number of rows, and rows are added up inside their part. Only
    groups that reach into a second part need the totals of earlier parts, which
    are fewer than there are parts. ``blocks`` is the number of parts; without
    it the number of rows decides. The rows and the counted rows are stored in the
    shared folder, as all these steps read them.
    """
    columns = df.columns
    check_unique([*columns, *_OWN])
    group = [quoted(k) for k in keys]
    ties = [quoted(c) for c in columns if c != order and c not in keys]
    sequence = [quoted(order).asc_nulls_last(), *ties, F.col("_value")]
    valued = settle(df.withColumn("_value", F.coalesce(value, F.lit(0))), "valued")
    whole = [*[quoted(c) for c in columns], F.col("_value")]
    tasks = row_tasks(valued)
    copies = F.count(F.lit(1)).alias("_copies")
    counted = valued.repartition(tasks, *whole).groupBy(*whole).agg(copies)
    ranges = [*group, *sequence]
    cut = counted.repartitionByRange(blocks or tasks, *ranges)
    counted = settle(cut.withColumn("_block", F.spark_partition_id()), "counted")

    amount = F.col("_value") * F.col("_copies")
    zero = F.lit(0)
    past = (Window.unboundedPreceding, -1)
    earlier_rows = Window.partitionBy(*group, "_block").orderBy(*sequence).rowsBetween(*past)
    earlier_blocks = Window.partitionBy(*group).orderBy("_block").rowsBetween(*past)
    dealt = counted.repartition(tasks, *group, "_block")
    inside = dealt.withColumn("_inside", F.coalesce(F.sum(amount).over(earlier_rows), zero))
    totals = (
        counted.groupBy(*group, "_block")
        .agg(F.sum(amount).alias("_total"))
        .withColumn("_before", F.sum("_total").over(earlier_blocks))
        .where("_before is not null")
        .drop("_total")
    )
    right = {k: f"_right_{k}" for k in [*keys, "_block"]}
    same_block = [quoted(k).eqNullSafe(quoted(r)) for k, r in right.items()]
    later_parts = settle(totals, "totals").withColumnsRenamed(right)
    placed = inside.join(later_parts, same_block, "left")
    repeated = repeat_rows(placed, "_copies", "_copy", largest(counted, "_copies"))
    total = (
        F.coalesce(F.col("_before"), zero)
        + F.col("_inside")
        + F.col("_copy") * F.col("_value")
    )
    return repeated.select(*[quoted(c) for c in columns], total.alias(out))
