import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerleaf import scratch
from ledgerleaf.operators import running


def _brute_force(rows):
    totals, wanted = defaultdict(int), []
    ordered = sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2], r[3] or 0))
    for key, order, name, value in ordered:
        wanted.append((key, order, name, value, totals[key]))
        totals[key] += value or 0
    return sorted(wanted, key=str)


@pytest.mark.parametrize("blocks", [None, 1, 7])
def test_running_total(spark, blocks):
    rng = random.Random(blocks)
    rows = [
        (rng.choice([1, 1, 1, 2, 3]), rng.randint(0, 40), rng.choice("xy"), rng.choice([0, 5, 7]))
        for _ in range(400)
    ]
    rows += [(1, 5, "x", 7)] * 50 + [(None, 1, "x", 2), (None, 2, "x", 2), (2, None, "x", 3)]
    df = spark.createDataFrame(rows, "id int, ref int, name string, secs int")
    result = running.running_total_before(df, ["id"], "ref", F.col("secs"), "before", blocks)
    assert sorted([tuple(r) for r in result.collect()], key=str) == _brute_force(rows)


@pytest.mark.parametrize("step", [10_000, 0])
def test_hot_group_is_cut_by_rows(spark, monkeypatch, step):
    """One group, its order values far apart or all equal."""
    stored = []

    def settle(df, label):
        result = scratch.settle(df, label)
        stored.append((label, result))
        return result

    monkeypatch.setattr(running, "settle", settle)
    df = spark.range(100_000).select(
        F.lit(1).alias("id"),
        (F.col("id") * step).alias("ref"),
        F.format_string("%06d", "id").alias("name"),
        F.lit(2).alias("secs"),
    )
    result = running.running_total_before(df, ["id"], "ref", F.col("secs"), "before", blocks=8)
    assert result.where(F.col("before") != 2 * F.col("name").cast("long")).count() == 0
    assert result.count() == 100_000
    counted = dict(stored)["counted"]
    largest = counted.groupBy("id", "_block").count().agg(F.max("count")).first()[0]
    assert largest < 100_000 / 4


@pytest.mark.parametrize("most", [1, 37])
def test_rows_without_copies_are_left_out(spark, most):
    df = spark.createDataFrame([("a", most), ("d", 0)], "k string, n bigint")
    found = running.repeat_rows(df, "n", "i", running.largest(df, "n")).collect()
    assert {r.k for r in found} == {"a"} and len(found) == most


def test_many_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(running, "COPIES_PER_TASK", 10)
    df = spark.createDataFrame([("a", 1), ("b", 37), ("c", 10), ("d", 0), ("e", 11)], "k string, n bigint")
    result = running.repeat_rows(df, "n", "i", running.largest(df, "n"))
    found = sorted((r.k, r.i) for r in result.collect())
    assert found == sorted((k, i) for k, n in [("a", 1), ("b", 37), ("c", 10), ("e", 11)] for i in range(n))


def test_running_total_with_many_copies(spark, monkeypatch):
    monkeypatch.setattr(running, "COPIES_PER_TASK", 10)
    df = spark.createDataFrame([(1, 1, 3)] * 25 + [(1, 2, 5)], "id int, ref int, secs int")
    result = running.running_total_before(df, ["id"], "ref", F.col("secs"), "before")
    found = sorted((r.ref, r.before) for r in result.collect())
    assert found == [(1, 3 * i) for i in range(25)] + [(2, 75)]


def test_tasks_follow_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(running, "ROWS_PER_TASK", 10)
    rows = [(i % 7, i // 7, i % 5) for i in range(700)]
    df = spark.createDataFrame(rows, "g int, at int, v int")
    stored = []
    settle = running.settle

    def noted(df, label="table"):
        found = settle(df, label)
        stored.append((label, df.rdd.getNumPartitions()))
        return found

    monkeypatch.setattr(running, "settle", noted)
    found = running.running_total_before(df, ["g"], "at", F.col("v"), "before")
    wanted = {(g, at): sum(v for h, b, v in rows if h == g and b < at) for g, at, _ in rows}
    assert {(r.g, r.at): r.before for r in found.collect()} == wanted
    # Not by bytes, of which all of these rows have too few for a second task.
    assert dict(stored)["counted"] >= 35
