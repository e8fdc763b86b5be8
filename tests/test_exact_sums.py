"""Exact sums of doubles against fractions."""

import math
import random
import struct
from fractions import Fraction

import pytest

from ledgerleaf.functions.exact_sums import exact_sums


def rounded(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) or math.isinf(v) for v in values):
        return sum(values)
    total = sum(map(Fraction, values))
    try:
        return total.numerator / total.denominator
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def same(a, b):
    return (a is None and b is None) or (a is not None and struct.pack("d", a) == struct.pack("d", b))


def any_double(rng):
    while True:
        value = struct.unpack("d", rng.randbytes(8))[0]
        if math.isfinite(value):
            return value


@pytest.mark.parametrize("parts", [1, 7])
def test_random_doubles(spark, parts):
    rng = random.Random(3)
    kinds = [
        lambda: any_double(rng),
        lambda: rng.uniform(-1e6, 1e6),
        lambda: rng.choice([1, -1]) * 2.0 ** rng.randrange(-1074, 1000),
        lambda: rng.choice([0.1, -0.1, 1e16, -1e16, 5e-324, 0.0]),
        lambda: math.nextafter(2.0 ** (26 * rng.randrange(-40, 39) + 18), rng.choice([0, math.inf])),
    ]
    rows = []
    for group in range(60):
        kind = kinds[group % len(kinds)]
        for _ in range(rng.randrange(1, 40)):
            rows.append((group, kind(), rng.choice([None, kind()])))
    df = spark.createDataFrame(rows, "g int, x double, `y.z` double").repartition(parts)
    found = {r.g: r for r in exact_sums(df, ["g"], ["x", "y.z"]).collect()}
    assert len(found) == 60
    for group, row in found.items():
        mine = [r for r in rows if r[0] == group]
        assert same(row.x, rounded([r[1] for r in mine]))
        assert same(row["y.z"], rounded([r[2] for r in mine]))


def test_special_values(spark):
    inf, nan = math.inf, math.nan
    groups = {
        "a": [inf, 1.0], "b": [-inf, 1.0], "c": [inf, -inf], "d": [nan, 1.0], "e": [None, None],
        "f": [1.7e308, 1.7e308], "g": [1.7e308, 1.7e308, -1.7e308], "h": [-0.0, -0.0], None: [1.0, 2.0],
        "i": [-1.7e308, -1.7e308], "k": [5e-324, 5e-324], "l": [1.0, 2.0**-53, 2.0**-1074],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    found = {r.k: r.x for r in exact_sums(spark.createDataFrame(rows, "k string, x double"), ["k"], ["x"]).collect()}
    wanted = {
        "a": inf, "b": -inf, "e": None, "f": inf, "g": 1.7e308, "h": 0.0, None: 3.0, "i": -inf, "k": 1e-323,
        "l": 1.0 + 2.0**-52,
    }
    assert math.isnan(found.pop("c")) and math.isnan(found.pop("d"))
    assert all(same(found.pop(k), v) for k, v in wanted.items()) and not found


def test_no_rows_no_keys_and_clashing_names(spark):
    df = spark.createDataFrame([(0.1, 1, 2, 3)] * 10, "value0 double, place0_0 int, part int, limbs int")
    assert exact_sums(df.limit(0), ["part"], ["value0"]).collect() == []
    assert [tuple(r) for r in exact_sums(df, [], ["value0", "part"]).collect()] == [(1.0, 20.0)]
    found = exact_sums(df, ["limbs", "place0_0"], ["value0"])
    assert found.columns == ["limbs", "place0_0", "value0"] and found.count() == 1
    with pytest.raises(ValueError, match="collide"):
        exact_sums(df, ["part"], ["part"])
    with pytest.raises(ValueError, match="at least one"):
        exact_sums(df, ["part"], [])


def test_rows_are_added_up_before_they_move(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id / 7 AS x")
    plan = exact_sums(df, ["g"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "partial_sum" in plan
