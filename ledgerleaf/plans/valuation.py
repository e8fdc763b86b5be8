"""Cash-flow valuation: single equivalent scenario, present values, best estimates.

Detailed cash flows may have any number of rows per scenario and month. A
valuation first adds them up to one row per (scenario, month) before it
meets the discount factors, so only that grid is ever joined or shuffled.
``n_rows`` keeps how many detail rows a grid row stands for, which the
weights and the mean discount factor need.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from functools import reduce
from numbers import Number
from operator import add
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.names import (
    quoted,
    require_columns,
    standard_name,
    standardize_columns,
)
from ledgerleaf.operators.filters import is_stochastic, slice_filter
from ledgerleaf.scratch import settle

log = logging.getLogger(__name__)

T = "t"
SCENARIO = "scenario_no"
DISCOUNT = "discount_factor"
WEIGHT = "ess_weights"
N_ROWS = "n_rows"
ESS_SCENARIO = -1

Signs = dict[str, dict[str, Number]]


@dataclass
class ValuationConfig:
    """Which columns hold what, and how flows combine."""

    flows: list[str]
    scenario_col: str = SCENARIO
    month_col: str = T
    discount_col: str = DISCOUNT
    slice: dict[str, Any] = field(default_factory=dict)
    groupings: dict[str, Signs] = field(default_factory=dict)
    bel_definitions: Signs = field(default_factory=dict)
    last_scenario: int = 1000

    def __post_init__(self) -> None:
        self.flows = [standard_name(f) for f in self.flows]
        for group, components in self.groupings.items():
            for name, signs in components.items():
                _check_signs(f"{group}.{name}", signs)
        for group, signs in self.bel_definitions.items():
            _check_signs(group, signs)

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> ValuationConfig:
        """Read the JSON form of the settings.

        BEL definitions with signs that are not numbers are left out with a
        warning; asking for one of them later is then the same as asking for
        an unknown one.
        """
        bels = {}
        for name, signs in raw.get("bel_definitions", {}).items():
            if all(_is_number(s) for s in signs.values()):
                bels[name] = signs
            else:
                log.warning("BEL definition %s has signs that are not numbers: ignored", name)
        return cls(
            flows=raw["cfs"],
            scenario_col=raw["scenario_number_col"],
            month_col=raw["projection_month_col"],
            discount_col=raw["discount_col"],
            slice=raw.get("slice") or {},
            groupings=raw.get("cfs_groupings", {}),
            bel_definitions=bels,
            last_scenario=raw.get("last_scenario", 1000),
        )

    def chosen_groupings(self, names: list[str] | None) -> dict[str, Signs]:
        return _chosen(self.groupings, names)

    def chosen_bels(self, names: list[str] | None) -> Signs:
        return _chosen(self.bel_definitions, names)


def _is_number(value: Any) -> bool:
    return isinstance(value, Number) and not isinstance(value, bool)


def _check_signs(name: str, signs: dict[str, Any]) -> None:
    wrong = {k: v for k, v in signs.items() if not _is_number(v)}
    if wrong:
        raise ValueError(f"signs of {name} must be numbers, got {wrong}")


def _chosen(defined: dict, names: list[str] | None) -> dict:
    if names is None:
        return defined
    for name in names:
        if name not in defined:
            log.warning("%s is not defined: ignored", name)
    return {name: defined[name] for name in names if name in defined}


def _signed_sum(signs: dict[str, Number], prefix: str = "") -> Column:
    terms = [quoted(prefix + name) * F.lit(sign) for name, sign in signs.items()]
    return reduce(add, terms, F.lit(0))


def _group_columns(groupings: dict[str, Signs]) -> dict[str, Column]:
    return {
        f"{group}.{name}": _signed_sum(signs)
        for group, components in groupings.items()
        for name, signs in components.items()
    }


def group_flows(df: DataFrame, groupings: dict[str, Signs]) -> DataFrame:
    """Add a column ``<group>.<component>`` per signed sum; 0 without parts."""
    added = _group_columns(groupings)
    return df.select("*", *[expr.alias(name) for name, expr in added.items()])


def _standard(df: DataFrame, config: ValuationConfig) -> DataFrame:
    return standardize_columns(
        df,
        {
            config.month_col: T,
            config.discount_col: DISCOUNT,
            config.scenario_col: SCENARIO,
        },
    )


def load_cash_flows(cash_flows: DataFrame, config: ValuationConfig) -> DataFrame:
    """The configured slice, under standard names."""
    return _standard(cash_flows.where(slice_filter(config.slice)), config)


def load_scenarios(scenarios: DataFrame, config: ValuationConfig) -> DataFrame:
    """Scenario number, month and discount factor, under standard names."""
    columns = [config.scenario_col, config.month_col, config.discount_col]
    return _standard(scenarios.select(*[quoted(c) for c in columns]), config)


def join_scenarios(cash_flows: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Every cash-flow row with its discount factor; null where the scenario has none."""
    return cash_flows.join(scenarios, [SCENARIO, T], "left")


def _total(column: Column) -> Column:
    """Sum that skips nulls and is 0 without values."""
    return F.coalesce(F.sum(column), F.lit(0))


def _as_double(column: Column) -> Column:
    return column.cast("double")


def flow_grid(detail: DataFrame, flows: list[str]) -> DataFrame:
    """One row per (scenario, month): flow totals and the number of rows behind them."""
    return detail.groupBy(SCENARIO, T).agg(
        F.count(F.lit(1)).alias(N_ROWS), *[_total(quoted(c)).alias(c) for c in flows]
    )


def discounted_grid(detail: DataFrame, flows: list[str]) -> DataFrame:
    """:func:`flow_grid` of rows that have their discount factor, stored."""
    totals = [_total(quoted(c)).alias(c) for c in flows]
    grid = detail.groupBy(SCENARIO, T, DISCOUNT).agg(F.count(F.lit(1)).alias(N_ROWS), *totals)
    return settle(grid, "flow-grid")


def _add_weights(detail: DataFrame, grid: DataFrame, last_scenario: int) -> DataFrame:
    totals = (
        grid.where(is_stochastic(F.col(SCENARIO), last_scenario))
        .groupBy(T)
        .agg(F.sum(F.col(DISCOUNT) * F.col(N_ROWS)).alias("_total"))
    )
    weight = F.try_divide(_as_double(F.col(DISCOUNT)), _as_double(F.col("_total")))
    return (
        detail.join(totals, T, "left")
        .withColumn(WEIGHT, F.when(is_stochastic(F.col(SCENARIO), last_scenario), weight))
        .select(*[quoted(c) for c in detail.columns], WEIGHT)
    )


def ess_weights(detail: DataFrame, last_scenario: int = 1000) -> DataFrame:
    """Add ``ess_weights``: the share of a row's discount factor in its month's total.

    Only stochastic scenarios count and get a weight. The totals are one row per
    month, joined back by month, so a month with most of the rows is never
    gathered in one task.
    """
    return _add_weights(detail, discounted_grid(detail, []), last_scenario)


def ess_flows(grid: DataFrame, flows: list[str], last_scenario: int = 1000) -> DataFrame:
    """Single equivalent scenario, number -1: one row per month.

    Flows are means weighted by discount factor; the discount factor is the
    mean over the stochastic rows.
    """
    rows = F.col(N_ROWS)
    discount = F.col(DISCOUNT)
    known_rows = F.sum(F.when(discount.isNotNull(), rows))
    discount_total = F.sum(discount * rows)
    weighted = {
        c: F.try_divide(_as_double(_total(quoted(c) * discount)), _as_double(discount_total))
        for c in flows
    }
    mean_discount = F.try_divide(_as_double(discount_total), known_rows)
    return (
        grid.where(is_stochastic(F.col(SCENARIO), last_scenario))
        .groupBy(T)
        .agg(
            *[F.coalesce(expr, F.lit(0.0)).alias(c) for c, expr in weighted.items()],
            mean_discount.alias(DISCOUNT),
        )
        .select(
            F.lit(ESS_SCENARIO).alias(SCENARIO),
            T,
            DISCOUNT,
            *[quoted(c) for c in flows],
        )
    )


def with_ess(detail: DataFrame, flows: list[str], last_scenario: int = 1000) -> DataFrame:
    """Detail rows with their weights, and the rows of scenario -1 below them."""
    require_columns(detail, [SCENARIO, T, DISCOUNT, *flows])
    grid = discounted_grid(detail, flows)
    return _add_weights(detail, grid, last_scenario).unionByName(
        ess_flows(grid, flows, last_scenario), allowMissingColumns=True
    )


def present_values(df: DataFrame, flows: list[str]) -> DataFrame:
    """Discounted total of every flow, one row per scenario."""
    return df.groupBy(SCENARIO).agg(
        *[_total(quoted(c) * F.col(DISCOUNT)).alias(c) for c in flows]
    )


def present_value_vector(df: DataFrame, flows: list[str], discount: str) -> DataFrame:
    """Discounted total of every flow over the whole table: one row."""
    return df.agg(*[_total(quoted(c) * quoted(discount)).alias(c) for c in flows])


def best_estimates(pvs: DataFrame, definitions: Signs) -> DataFrame:
    """Add ``<definition>.bel``: the signed sum of the definition's present values."""
    for name, signs in definitions.items():
        require_columns(pvs, [f"{name}.{part}" for part in signs])
    added = {f"{name}.bel": _signed_sum(signs, f"{name}.") for name, signs in definitions.items()}
    return pvs.select("*", *[expr.alias(name) for name, expr in added.items()])


def valuation_grid(
    cash_flows: DataFrame,
    scenarios: DataFrame,
    config: ValuationConfig,
    groupings: list[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Discounted (scenario, month) grid and the names of its flow columns.

    The grid is stored: the cash flows are read once, whatever is computed from it.
    """
    chosen = config.chosen_groupings(groupings)
    flows = [*config.flows, *_group_columns(chosen)]
    detail = group_flows(load_cash_flows(cash_flows, config), chosen)
    grid = join_scenarios(flow_grid(detail, flows), load_scenarios(scenarios, config))
    return settle(grid, "flow-grid"), flows


def cash_flow_valuation(
    cash_flows: DataFrame,
    scenarios: DataFrame,
    config: ValuationConfig,
    groupings: list[str] | None = None,
    bel_definitions: list[str] | None = None,
) -> DataFrame:
    """Present values and best estimates per scenario, with scenario -1."""
    grid, flows = valuation_grid(cash_flows, scenarios, config, groupings)
    ess = ess_flows(grid, flows, config.last_scenario)
    every_scenario = grid.drop(N_ROWS).unionByName(ess)
    return best_estimates(
        present_values(every_scenario, flows), config.chosen_bels(bel_definitions)
    )
