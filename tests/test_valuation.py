import logging
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerleaf.plans import valuation as val

CONFIG = {
    "projection_month_col": "ProjMth",
    "discount_col": "discount factor - risk free rate",
    "scenario_number_col": "ScenarioNumber",
    "slice": {"book": 77},
    "cfs": ["Income – new business", "Income – renewal", "Benefits"],
    "cfs_groupings": {
        "main_book": {
            "premium": {"income_new_business": 1, "income_renewal": 1},
            "benefit": {"benefits": -1},
            "running_cost": {},
        },
        "side_book": {},
    },
    "bel_definitions": {
        "main_book": {"premium": -1, "benefit": 1, "running_cost": 1},
        "odd_book": {"premium": {}},
        "side_book": {},
    },
}


@pytest.fixture(scope="module")
def config():
    return val.ValuationConfig.from_dict(CONFIG)


def _random_inputs(spark, rows_per_cell=1, months=6, scenarios=4, seed=1):
    rng = random.Random(seed)
    flows, rates = [], []
    for s in range(scenarios):
        for t in range(months):
            rates.append((s, t, round(1 / (1.01 + 0.01 * s) ** t, 8)))
            for _ in range(rows_per_cell if not rows_per_cell == "varying" else rng.randint(1, 4)):
                flows.append((s, t, 77, *[round(rng.uniform(0, 100), 2) for _ in range(3)]))
            flows.append((s, t, 1, 1e6, 1e6, 1e6))
    cash_flows = spark.createDataFrame(
        flows,
        "ScenarioNumber int, ProjMth int, `book` int, `Income – new business` double,"
        " `Income – renewal` double, Benefits double",
    )
    discounts = spark.createDataFrame(
        rates, "ScenarioNumber int, ProjMth int, `discount factor - risk free rate` double"
    )
    return cash_flows, discounts, flows, rates


def test_present_value_vector(spark):
    income = [40, 60, 0, 20]
    benefits = [0, 8, 16, 32]
    factors = [1, 0.5, 0.25, 0.125]
    df = spark.createDataFrame(
        [
            (t, float(a), float(b), float(d))
            for t, (a, b, d) in enumerate(zip(income, benefits, factors, strict=True))
        ],
        "t int, income double, benefits double, factor double",
    )
    row = val.present_value_vector(df, ["income", "benefits"], "factor").first()
    assert (row.income, row.benefits) == (72.5, 12.0)


def test_single_equivalent_scenario_is_the_mean(spark, config):
    """With a row for every scenario and month, PV(-1) is the mean PV of scenarios 1 to n."""
    cash_flows, discounts, _, _ = _random_inputs(spark)
    pvs = {r.scenario_no: r for r in val.cash_flow_valuation(cash_flows, discounts, config).collect()}
    for flow in [*config.flows, "main_book.premium", "main_book.bel"]:
        mean = sum(pvs[s][flow] for s in (1, 2, 3)) / 3
        assert pvs[-1][flow] == pytest.approx(mean)
    assert set(pvs) == {-1, 0, 1, 2, 3}


def test_valuation_against_rows(spark, config):
    """Several rows per scenario and month, computed one by one in Python."""
    cash_flows, discounts, flows, rates = _random_inputs(spark, rows_per_cell="varying", seed=5)
    factor = {(s, t): d for s, t, d in rates}
    kept = [(s, t, *amounts) for s, t, group, *amounts in flows if group == 77]
    total, count = defaultdict(float), defaultdict(int)
    for s, t, *_ in kept:
        if s > 0:
            total[t] += factor[s, t]
            count[t] += 1
    pv = defaultdict(lambda: [0.0, 0.0, 0.0])
    for s, t, *amounts in kept:
        for i, amount in enumerate(amounts):
            pv[s][i] += amount * factor[s, t]
            if s > 0:
                weight = factor[s, t] / total[t]
                pv[-1][i] += amount * weight * total[t] / count[t]
    result = {r.scenario_no: r for r in val.cash_flow_valuation(cash_flows, discounts, config).collect()}
    assert set(result) == set(pv)
    for s, values in pv.items():
        assert [result[s][f] for f in config.flows] == pytest.approx(values)
        bel = -(values[0] + values[1]) + -values[2]
        assert result[s]["main_book.bel"] == pytest.approx(bel)
        assert result[s]["side_book.bel"] == 0


def test_weights_add_up_to_one(spark, config):
    cash_flows, discounts, _, _ = _random_inputs(spark, rows_per_cell=3)
    detail = val.join_scenarios(
        val.load_cash_flows(cash_flows, config), val.load_scenarios(discounts, config)
    )
    weighted = val.ess_weights(detail)
    assert weighted.where("scenario_no = 0 AND ess_weights IS NOT NULL").count() == 0
    sums = weighted.where("scenario_no > 0").groupBy("t").agg(F.sum("ess_weights").alias("w"))
    assert all(r.w == pytest.approx(1) for r in sums.collect())


def test_with_ess_appends_rows(spark, config):
    cash_flows, discounts, _, _ = _random_inputs(spark)
    detail = val.join_scenarios(
        val.load_cash_flows(cash_flows, config), val.load_scenarios(discounts, config)
    )
    both = val.with_ess(detail, config.flows)
    assert both.count() == detail.count() + 6
    ess = both.where("scenario_no = -1")
    assert ess.where("ess_weights IS NOT NULL OR book IS NOT NULL").count() == 0


def test_missing_values(spark):
    rows = [(1, 0, 10.0, 0.5), (2, 0, None, 0.25), (1, 1, 5.0, None), (0, 1, 7.0, 1.0)]
    detail = spark.createDataFrame(rows, "scenario_no int, t int, benefits double, discount_factor double")
    both = {(r.scenario_no, r.t): r for r in val.with_ess(detail, ["benefits"]).collect()}
    assert both[-1, 0].benefits == pytest.approx(10 * 0.5 / 0.75)
    assert both[-1, 0].discount_factor == pytest.approx(0.375)
    assert both[-1, 1].benefits == 0 and both[-1, 1].discount_factor is None
    pvs = {r.scenario_no: r.benefits for r in val.present_values(detail, ["benefits"]).collect()}
    assert pvs == {0: 7.0, 1: 5.0, 2: 0.0}


def test_group_with_a_missing_part_is_left_out(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 3.0, 4.0)], "scenario_no int, a double, b double")
    grouped = val.group_flows(df, {"g": {"both": {"a": 1, "b": 1}}})
    assert [r["g.both"] for r in grouped.collect()] == [None, 7.0]


def test_unknown_names_are_ignored(config, caplog):
    with caplog.at_level(logging.WARNING):
        assert config.chosen_groupings(["main_book", "nope"]).keys() == {"main_book"}
        assert config.chosen_bels(["odd_book"]) == {}
    assert "nope" in caplog.text and "odd_book" in caplog.text


def test_signs_must_be_numbers():
    with pytest.raises(ValueError, match="numbers"):
        val.ValuationConfig(flows=["a"], groupings={"g": {"x": {"a": {}}}})


def test_best_estimate_is_linear_in_signs(spark):
    pvs = spark.createDataFrame([(1, 3.0, 5.0)], "scenario_no int, `d.a` double, `d.b` double")
    one = val.best_estimates(pvs, {"d": {"a": 1, "b": -2}}).first()["d.bel"]
    two = val.best_estimates(pvs, {"d": {"a": 2, "b": -4}}).first()["d.bel"]
    assert (one, two) == (-7.0, -14.0)
    with pytest.raises(ValueError, match="d.c"):
        val.best_estimates(pvs, {"d": {"c": 1}})
