"""Three statements over cash flows and discount scenarios.

Table names are parameters, so one text serves every valuation run. Nothing is
cached: each statement reads only the columns it needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.sources.tables import run_query_text

JOINED = """
    SELECT a.*, b.ScnNumber AS discount_ScnNumber, b.ProjMonth, b.Discount_Factor
    FROM IDENTIFIER(:cash_flows) AS a
    JOIN IDENTIFIER(:discounts) AS b
      ON a.ScnNumber = b.ScnNumber AND a.RowNo = b.ProjMonth
"""
TOTAL_DEATH = "SELECT sum(death) AS total_death FROM IDENTIFIER(:cash_flows) WHERE Step > 0"
DISCOUNT_COUNT = "SELECT count(*) AS cnt FROM IDENTIFIER(:discounts)"


@dataclass(frozen=True)
class ScenarioPack:
    joined: DataFrame
    total_death: DataFrame
    discount_count: DataFrame


def scenario_pack(spark: SparkSession, cash_flows: str, discounts: str) -> ScenarioPack:
    """Flows with their discount rows, total deaths after step 0, number of discount rows."""
    both = {"cash_flows": cash_flows, "discounts": discounts}
    return ScenarioPack(
        run_query_text(spark, JOINED, both),
        run_query_text(spark, TOTAL_DEATH, {"cash_flows": cash_flows}),
        run_query_text(spark, DISCOUNT_COUNT, {"discounts": discounts}),
    )
