import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerleaf.functions.keys import combo_key
from ledgerleaf.functions.names import (
    columns_with_prefix,
    quoted,
    require_columns,
    standard_name,
    standard_name_of,
    standardize_columns,
)


def test_standard_name():
    assert standard_name("seg/separate Acct - Expenses(*)") == "seg_separate_acct_expenses"
    assert standard_name("Premiums – first year") == "premiums_first_year"
    assert standard_name("  a_ b  ") == "a__b"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB9_ -/(\t\n.é–", max_size=12), min_size=1, max_size=20))
def test_value_rule_equals_name_rule(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "raw string")
    rows = df.select("raw", standard_name_of(F.col("raw")).alias("std")).collect()
    for row in rows:
        spaced = re.sub(r"[^0-9a-z_\s]", " ", row["raw"].lower()).strip()
        assert row["std"] == re.sub(r"\s+", "_", spaced) == standard_name(row["raw"])


def test_standardize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`ProjMth` int, `Total Claims (net)` int")
    assert standardize_columns(df, {"ProjMth": "t"}).columns == ["t", "total_claims_net"]


def test_colliding_names_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="collide"):
        standardize_columns(df)


def test_require_and_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "tag_a int, x int, tag_b int")
    assert columns_with_prefix(df, "tag_") == ["tag_a", "tag_b"]
    with pytest.raises(ValueError, match="zz"):
        require_columns(df, ["x", "zz"])


def test_combo_key_keeps_missing_parts(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y int, `z.z` string")
    found = [r[0] for r in df.select(combo_key(["x", "y", "z.z"])).collect()]
    assert found == ["a|nan|c", "nan|nan|nan"]
    assert df.select(quoted("z.z")).first()[0] == "c"
    with pytest.raises(ValueError):
        combo_key([])
