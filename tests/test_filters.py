from pyspark.sql import functions as F

from ledgerleaf.operators.filters import (
    differs_or_missing,
    has_content,
    is_stochastic,
    name_excluded,
    slice_filter,
)


def test_slice_filter(spark):
    df = spark.createDataFrame([(900001, "A'x"), (900001, "b"), (2, "A'x")], "`group id` int, name string")
    assert df.where(slice_filter({"group id": 900001, "name": "A'x"})).count() == 1
    assert df.where(slice_filter({})).count() == 3


def test_slice_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet").where(slice_filter({"c_nationkey": 7}))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_nationkey,7)" in plan


def test_null_rules(spark):
    df = spark.createDataFrame([(3,), (4,), (None,)], "act int")
    assert df.where(differs_or_missing(F.col("act"), 3)).count() == 2


def test_stochastic(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (1000,), (1001,)], "s int")
    assert [r.s for r in df.where(is_stochastic(F.col("s"))).collect()] == [1, 1000]


def test_text_filters(spark):
    df = spark.createDataFrame([("Sheet1", ""), ("sheet2", "x"), ("Mod", None)], "name string, text string")
    assert df.where(name_excluded(F.col("name"), "^SHEET")).count() == 2
    assert [r.name for r in df.where(has_content(F.col("text"))).collect()] == ["sheet2"]
