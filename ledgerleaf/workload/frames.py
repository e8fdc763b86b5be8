"""The star-schema tables seen as inputs of the jobs.

Amounts become decimals, so sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions.stat_code import ESTI, FLEX, MIPS_BY_STATUS, MIPS_PAID, SCHD
from ledgerleaf.operators.running import row_tasks
from ledgerleaf.plans.profile import FINISH_CODE, START_CODE
from ledgerleaf.plans.valuation import ValuationConfig

FIRST_YEAR = 1992

VALUATION = ValuationConfig(
    flows=["Income – new business", "Income – renewal", "Benefits"],
    scenario_col="ScenarioNumber",
    month_col="ProjMth",
    discount_col="discount factor - risk free rate",
    slice={"line status": "F"},
    groupings={
        "main_book": {
            "premium": {"income_new_business": 1, "income_renewal": 1},
            "benefit": {"benefits": -1},
            "savings_part": {},
            "running_cost": {},
            "selling_cost": {},
        },
        "side_book": {},
    },
    bel_definitions={
        "main_book": {
            "premium": -1,
            "benefit": 1,
            "savings_part": 1,
            "running_cost": 1,
            "selling_cost": 1,
        },
        "side_book": {},
    },
)
# The same settings without a slice, for operators whose feature it is not.
WHOLE_VALUATION = replace(VALUATION, slice={})
GROUPED_FLOWS = [f"main_book.{name}" for name in VALUATION.groupings["main_book"]]

PLAN_CODES = [*MIPS_BY_STATUS, *MIPS_PAID, *SCHD, *FLEX, *ESTI, "SCHD"]
# Fixed values.
MOSES_CODES = ["PRM5", "PRM6", "PRM3", "PRM4", "PRM2"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str | Column, scale: int = 2) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast(f"decimal(14,{scale})")


def _projection_month(date: str) -> Column:
    return (F.year(date) - FIRST_YEAR) * 12 + F.month(date) - 1


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with exact amounts, for reports."""
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.year("l_shipdate").alias("ship_year"),
        money("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("price"),
        (money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).alias("rebate"),
    )


def cash_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as cash flows: scenario 0 is deterministic, 1 to 6 are stochastic."""
    price = money("l_extendedprice")
    first_year = F.col("l_returnflag") == "N"
    zero = F.lit(0).cast("decimal(14,2)")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") - 1).alias("ScenarioNumber"),
        _projection_month("l_shipdate").alias("ProjMth"),
        F.col("l_linestatus").alias("line status"),
        F.when(first_year, price).otherwise(zero).alias("Income – new business"),
        F.when(first_year, zero).otherwise(price).alias("Income – renewal"),
        money(price * F.col("l_discount").cast("decimal(4,2)"), 4).alias("Benefits"),
    )


def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A discount factor for every scenario and month that occurs."""
    rate = F.lit(1.0) + (F.col("ScenarioNumber") + 2) / F.lit(100.0)
    factor = F.round(F.pow(rate, -F.col("ProjMth") / F.lit(12.0)), 8)
    return (
        cash_flows(spark, sf_dir)
        .select("ScenarioNumber", "ProjMth")
        .distinct()
        .withColumn("discount factor - risk free rate", factor.cast("decimal(10,8)"))
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as cells to be mapped; ``table_premium`` is a stale assumption."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_brand").alias("tag_brand"),
        F.col("p_type").alias("tag_type"),
        F.col("p_size").alias("tag_size"),
        F.lit("").alias("table_premium"),
    )


def cell_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping rows: each type of small sizes, each brand of any type, and a few patterns."""
    part = table(spark, sf_dir, "part")
    by_type = part.select(
        F.lit(".*").alias("tag_brand"),
        F.col("p_type").alias("tag_type"),
        F.lit("[1-9]").alias("tag_size"),
    ).distinct()
    by_brand = part.select(
        F.col("p_brand").alias("tag_brand"),
        F.lit(".*").alias("tag_type"),
        F.col("p_size").cast("string").alias("tag_size"),
    ).distinct()
    fixed = spark.createDataFrame(
        [
            ("Brand#1.", "SMALL", "1.*"),
            ("Brand#2[0-4]", "LARGE|PROMO", ".*"),
            (".*", ".*", "5."),
        ],
        by_type.schema,
    )
    rows = by_type.unionByName(by_brand).unionByName(fixed)
    tags = ["tag_brand", "tag_type", "tag_size"]
    return rows.select(
        *tags,
        F.concat_ws("_", F.lit("Premiums"), *tags).alias("table_premium"),
        F.concat_ws("_", F.lit("Min"), *tags).alias("table_min_premium"),
    )


def key_patterns(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            ("Customer#0000000[0-4]", "low"),
            (".*7$", "seven"),
            ("Customer#.*99|Customer#.*00", "edge"),
            ("ustomer", "never"),
        ],
        "pattern string, band string",
    )


def supplier_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three patterns for each supplier: digits anywhere, a class before them, alternatives."""
    number = F.lpad((F.col("s_suppkey") % 1000).cast("string"), 3, "0")
    patterns = F.array(
        F.concat(F.lit(".*"), number, F.lit(".*")),
        F.concat(F.lit("[CD]ustomer#0+"), number, F.lit(".?$")),
        F.concat(F.lit(".*"), number, F.lit("1$|.*7"), number, F.lit("|Supplier.*"), number),
    )
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.posexplode(patterns).alias("form", "pattern")
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as batches."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.concat_ws(" ", F.lit("Order"), F.col("o_orderkey"), "o_orderpriority").alias("Name"),
    )


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines: open orders never start, only finished ones end, urgent ones start twice."""
    clock = "M/d/yyyy H:mm:ss"
    start = F.col("o_orderdate")
    line = "struct<seq:int,No:int,after:int,kept:boolean>"
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    lines = F.array(
        F.struct(F.lit(1), F.lit(START_CODE), F.lit(0), status != "O").cast(line),
        F.struct(
            F.lit(2), F.lit(START_CODE), F.lit(30), (status != "O") & (priority == "1-URGENT")
        ).cast(line),
        F.struct(F.lit(3), F.lit(FINISH_CODE), F.lit(120), status == "F").cast(line),
        F.struct(F.lit(4), F.lit(1), F.lit(200), F.lit(True)).cast(line),
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("line", F.explode(F.filter(lines, lambda x: x["kept"])))
        .select(
            (F.col("o_orderkey") * 10 + F.col("line.seq")).alias("Id"),
            F.col("line.No").alias("No"),
            F.col("o_orderkey").alias("BatchId"),
            F.date_format(
                start + F.make_dt_interval(secs=F.col("line.after")), clock
            ).alias("Timestamp"),
        )
    )


def batch_step_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as steps: one per order and supplier, as long as its quantity in seconds."""
    seconds = F.sum(F.col("l_quantity").cast("bigint"))
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(seconds / 3600),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60),
        F.pmod(seconds, F.lit(60)),
    )
    items = table(spark, sf_dir, "lineitem")
    # One shuffle by what the steps are joined by, too.
    return (
        items.repartition(row_tasks(items), "l_orderkey")
        .groupBy(F.col("l_orderkey").alias("Id"), F.col("l_suppkey").alias("Reference"))
        .agg(
            F.max("l_linenumber").alias("Act"),
            F.nullif(F.char(F.max(F.ascii("l_returnflag"))), F.lit("N")).alias("ArgumentNameTmp"),
            F.when(seconds != 13, clock).alias("Time"),
        )
    )


def _pick(options: list[str], number: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(o) for o in options]), (F.pmod(number, F.lit(len(options))) + 1).cast("int")
    )


def ten_thousandths(amount: Column) -> Column:
    """Amount in units of 0.0001, a whole number, so that sums of doubles are exact."""
    return F.rint(amount * 10_000)


def policies(
    spark: SparkSession, sf_dir: str, unit: Callable[[Column], Column] = ten_thousandths
) -> DataFrame:
    """Line items with their order and part as policies under valuation, amounts in a unit.

    Fixed values: the names of the columns, which the reserve job expects.
    """
    item = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    joined = item.join(order, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    flag = F.col("l_returnflag")
    prefix = F.when(flag == "A", "I_").when(flag == "R", "U_").otherwise("")
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    discount, tax = F.col("l_discount"), F.col("l_tax")
    amounts = {
        "UL Seg Fund/ Sep Acct Balance": price,
        "UDV31_GID": price * discount,
        "Accrued Admin Charge": price * tax,
        "Accrued Asset Credit": quantity * discount,
        "Accrued Net Loan Cost": quantity * tax,
        "Accrued COI": quantity,
        "Accrued Load": F.when(F.col("l_linenumber") != 7, discount),
        "Reserve details - AG37 AALR": F.when(flag != "N", price * tax),
        "Reserve details - AG37 OYT Res": price * discount,
        "Stat Res - Gross reserve": F.col("p_retailprice"),
        "Stat Res - Gross deficiency reserve": tax,
        "Tax Res - Gross reserve": F.col("p_retailprice") * discount,
    }
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(prefix, F.col("p_name")).alias("Cell Name ALPHA"),
        _pick(PLAN_CODES, F.col("p_size")).alias("Plan Code"),
        _pick(MOSES_CODES, F.col("l_linenumber")).alias("MoSes Plan Code"),
        F.when(F.col("o_orderpriority") != "5-LOW", "P").alias("med_flag"),
        F.when(F.col("l_linestatus") == "F", "0").otherwise("_").alias("era"),
        (F.pmod("l_suppkey", F.lit(5)) + 1).cast("int").alias("Statutory Company"),
        F.year("o_orderdate").alias("Iss Year"),
        *[unit(amount).alias(name) for name, amount in amounts.items()],
    )


def policy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as policies: the key repeats the first letter of the segment."""
    key = F.lower(F.repeat(F.substring("c_mktsegment", 1, 1), 3))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", key.alias("policy_id"), F.reverse(key).alias("lpolicy_id")
    )


def lien_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of their customer's notes."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    day = F.date_format("o_orderdate", "MMddyyyy")
    amounts = F.concat(
        F.lit("LTCC: $"),
        F.format_number(price / 2, 2),
        F.lit("(M), $"),
        F.format_number(price.cast("decimal(14,2)"), 2),
        F.lit("(C) LIEN "),
        day,
    )
    line = (
        F.when(status == "F", amounts)
        .when(status == "P", F.concat(F.lit("LIEN released "), day))
        .otherwise(F.concat(F.lit("no change "), day))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("policy_id"), F.col("o_orderkey").alias("line_no"), line.alias("line")
    )


def lien_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a note of three lines: opened, a lien of its price, then its state."""
    status = F.col("o_orderstatus")
    first = F.concat(
        F.lit("LTCC: $0.00(M), $"),
        F.format_number(F.col("o_totalprice").cast("decimal(14,2)"), 2),
        F.lit("(C) LIEN 01011999"),
    )
    last = F.when(status == "F", "LTCC: $3.00(M), $7,081.00(C) LIEN 02021999").when(
        status == "P", "LIEN without amount"
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("policy_id"),
        F.concat_ws("\n", F.concat(F.lit("opened by "), F.col("o_custkey")), first, last).alias("text"),
    )


def modules(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as modules, before and after: some sources are new, English texts grow a line."""
    docs = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("Module"), F.col("doc_id"))
    old = docs.where(~F.col("source").startswith("src1")).select(name.alias("name"), "text")
    grown = F.concat(F.col("text"), F.lit("\nEnd Sub"))
    new = docs.select(
        name.alias("name"),
        F.when(F.col("lang") == "en", grown).otherwise(F.col("text")).alias("text"),
    )
    return old, new
