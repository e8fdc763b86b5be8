"""Extended reserves per policy and their summary by legal entity.

All steps are column expressions, so a summary is one scan, a partial sum per
task and one small shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions.exact_sums import exact_sums
from ledgerleaf.functions.names import quoted
from ledgerleaf.functions.stat_code import (
    ESTI,
    TFLIC_COMPANIES,
    TLIC_COMPANIES,
    stat_code,
)

# Share of the statutory death-benefit reserve allowed for tax.
TAX_GMDB_FACTOR = Decimal("0.9281")

# Cost centre of the journal entries.
CENTER = "101M0000"

# Mortality basis by policy attributes.
MORTALITY_BASIS_ROWS = [
    ("MSA", "PRM5", "P", "_", "regular", "CET80"),
    ("P6S", "PRM6", "P", "0", "regular", "CET80"),
    ("P6J", "PRM6", "P", "0", "regular", "CET80"),
    ("P7S", "PRM6", "P", "0", "regular", "CET80"),
    ("P7J", "PRM6", "P", "0", "regular", "CET80"),
    ("P8S", "PRM6", "P", "0", "regular", "CET80"),
    ("P8J", "PRM6", "P", "0", "regular", "CET80"),
]
MORTALITY_BASIS_KEYS = ["plan_code", "moses_plan_code", "med_flag", "era", "lapse_status"]

STAT_CODE_COLUMNS = {
    "plan_code": "Plan Code",
    "moses_plan_code": "MoSes Plan Code",
    "company_code": "Statutory Company",
    "issue_year": "Iss Year",
    "med_flag": "med_flag",
    "era": "era",
    "lapse_status": "lapse_status",
}

# Published field -> computed measure; None is a field that is always 0.
JOURNAL_FIELDS = {
    "JE_2001D1R": "stat_ga_reserve",
    "JE_2001C1R": None,
    "JE_200DD1R": "stat_gmdb_reserve",
    "JE_200AD1R": "stat_def_reserve",
    "JE_2008D1R": None,
    "JE_150211R": None,
    "JE_151211R": None,
    "JE_2061D1R": None,
}
EXHIBIT_FIELDS = {
    "ex5_A_direct": "stat_ga_reserve",
    "ex5_A_ceded": None,
    "ex5_G_gmdb": "stat_gmdb_reserve",
    "ex5_G_def": "stat_def_reserve",
    "ex5_G_ceded": None,
    "ex5_E_alr": None,
    "ex5_F_dlr": None,
}
TAX_FIELDS = {
    name.replace("JE_", "Tax_"): measure and measure.replace("stat_", "tax_")
    for name, measure in JOURNAL_FIELDS.items()
}
KC4_FIELDS = {
    "KC4_total_stat": "stat_total_liability",
    "KC4_total_tax": "tax_total_liability",
    "KC4_stat_sa": "stat_sa_reserve",
    "KC4_tax_sa": "tax_sa_reserve",
    "KC4_stat_ga": "stat_ga_reserve",
    "KC4_tax_ga": "tax_ga_reserve",
    "KC4_stat_gmdb_reserve": "stat_gmdb_reserve",
    "KC4_tax_gmdb_reserve": "tax_gmdb_reserve",
    "KC4_stat_def_reserve": "stat_def_reserve",
    "KC4_tax_def_reserve": "tax_def_reserve",
    "KC4_stat_ceded_reserve": None,
    "KC4_tax_ceded_reserve": None,
}
SUMMED_FIELDS = [*JOURNAL_FIELDS, *EXHIBIT_FIELDS, *TAX_FIELDS, *KC4_FIELDS]


def lapse_status(cell_name: Column) -> Column:
    """Reduced paid-up and extended-term policies carry a prefix in their cell name."""
    return (
        F.when(cell_name.startswith("U_"), "rpu")
        .when(cell_name.startswith("I_"), "eti")
        .otherwise("regular")
    )


def legal_entity(company: Column) -> Column:
    return (
        F.when(company.isin(TLIC_COMPANIES), "TLIC")
        .when(company.isin(TFLIC_COMPANIES), "TFLIC")
        .otherwise("undefined")
    )


def larger_or_second(first: Column, second: Column) -> Column:
    """``first`` where it is larger, else ``second``; unlike ``greatest``, a null
    on either side gives ``second``."""
    return F.when(first > second, first).otherwise(second)


def add_policy_attributes(raw: DataFrame) -> DataFrame:
    """Lapse status, legal entity, charges and death-benefit reserves."""
    is_esti = quoted("Plan Code").isin(ESTI)
    charges = (
        quoted("Accrued Admin Charge")
        + quoted("Accrued Asset Credit")
        + quoted("Accrued Net Loan Cost")
    )
    premium_charges = quoted("Accrued COI") + quoted("Accrued Load")
    gmdb = larger_or_second(
        quoted("Reserve details - AG37 AALR"), quoted("Reserve details - AG37 OYT Res")
    )
    return raw.select(
        "*",
        lapse_status(quoted("Cell Name ALPHA")).alias("lapse_status"),
        legal_entity(quoted("Statutory Company")).alias("legal_entity"),
        quoted("UL Seg Fund/ Sep Acct Balance").alias("investment_base"),
        quoted("UDV31_GID").alias("gid"),
        F.when(is_esti, charges).otherwise(charges + premium_charges).alias("accrued_charges"),
        F.when(is_esti, -premium_charges).otherwise(F.lit(0)).alias("unearned_coi"),
        gmdb.alias("stat_gmdb_reserve"),
        (gmdb * F.lit(TAX_GMDB_FACTOR)).alias("tax_gmdb_reserve"),
    )


def add_reserves(policies: DataFrame) -> DataFrame:
    """Statutory code and the reserves on both bases."""
    gross = quoted("Stat Res - Gross reserve")
    tax_gross = quoted("Tax Res - Gross reserve")
    status = F.col("lapse_status")
    separate = F.col("investment_base") - F.col("accrued_charges")
    first = policies.select(
        "*",
        stat_code(STAT_CODE_COLUMNS).alias("stat_code"),
        separate.alias("stat_sa_reserve"),
        separate.alias("tax_sa_reserve"),
        F.when(status == "eti", gross).otherwise(F.lit(0)).alias("stat_eti_reserve"),
        F.lit(0).alias("tax_eti_reserve"),
        F.when(status == "rpu", gross).otherwise(F.lit(0)).alias("stat_rpu_reserve"),
        F.lit(0).alias("tax_rpu_reserve"),
        quoted("Stat Res - Gross deficiency reserve").alias("stat_def_reserve"),
        F.lit(0).alias("tax_def_reserve"),
    )
    own = F.col("gid") + F.col("unearned_coi")

    def general_account(total: Column, basis: str) -> Column:
        held = (
            F.col("investment_base")
            + F.col(f"{basis}_gmdb_reserve")
            + F.col(f"{basis}_def_reserve")
        )
        return total + own - held

    return first.select(
        "*",
        (gross + own - F.col("accrued_charges")).alias("stat_total_liability"),
        (tax_gross + own - F.col("accrued_charges")).alias("tax_total_liability"),
        general_account(gross, "stat").alias("stat_ga_reserve"),
        general_account(tax_gross, "tax").alias("tax_ga_reserve"),
    )


def _published(fields: dict[str, str | None]) -> list[Column]:
    return [
        (F.lit(0) if measure is None else F.col(measure)).alias(name)
        for name, measure in fields.items()
    ]


def publish_fields(reserves: DataFrame) -> DataFrame:
    """Add the measures under their report field names."""
    return reserves.select(
        "*",
        F.lit(CENTER).alias("JE_center"),
        *_published(JOURNAL_FIELDS),
        F.col("stat_code").alias("ex5_stat_code"),
        *_published(EXHIBIT_FIELDS),
        F.lit(CENTER).alias("Tax_center"),
        *_published(TAX_FIELDS),
        *_published(KC4_FIELDS),
    )


def extended_reserves(raw: DataFrame) -> DataFrame:
    """One enriched row per policy."""
    return publish_fields(add_reserves(add_policy_attributes(raw)))


def reserve_summary(raw: DataFrame) -> DataFrame:
    """Sums of all published fields by legal entity, last entity name first.

    One shuffle; the last digits of sums of doubles depend on the order of rows.
    """
    return (
        extended_reserves(raw)
        .groupBy("legal_entity")
        .agg(*[F.sum(name).alias(name) for name in SUMMED_FIELDS])
        .orderBy(F.desc("legal_entity"))
    )


def exact_reserve_summary(raw: DataFrame) -> DataFrame:
    """:func:`reserve_summary` with sums that are rounded once, whatever the order of rows.

    Each measure is added up once, however many fields publish it.
    """
    published = {**JOURNAL_FIELDS, **EXHIBIT_FIELDS, **TAX_FIELDS, **KC4_FIELDS}
    measures = sorted({measure for measure in published.values() if measure})
    rows = add_reserves(add_policy_attributes(raw))
    sums = exact_sums(rows, ["legal_entity"], measures)
    fields = [
        (F.lit(0.0) if measure is None else F.col(measure)).alias(name)
        for name, measure in published.items()
    ]
    return sums.select("legal_entity", *fields).orderBy(F.desc("legal_entity"))


def mortality_basis_table(spark: SparkSession) -> DataFrame:
    columns = [*MORTALITY_BASIS_KEYS, "mortality_basis"]
    return spark.createDataFrame(MORTALITY_BASIS_ROWS, ", ".join(f"{c} string" for c in columns))


def join_mortality_basis(policies: DataFrame) -> DataFrame:
    """Attach the basis from the fixed table; null where the table has no row."""
    table = mortality_basis_table(policies.sparkSession)
    return policies.join(F.broadcast(table), MORTALITY_BASIS_KEYS, "left")
