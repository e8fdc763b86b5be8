"""Statutory valuation code of a policy."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Plan codes of each product family.
MIPS_BY_STATUS = ["7PY", "L83", "L84", "V81", "V83", "V84", "LPE", "VPE"]
MIPS_PAID = ["P83", "PP3", "PP4", "S81", "S83"]
SCHD = ["SP1"]
FLEX = ["P1J", "P1S", "P2J", "P2S", "MSA", "P6S", "P6J", "P7S", "P7J", "P8S", "P8J", "A1S"]
ESTI = ["EIS", "EIJ"]

# Codes of each plan family by what decides them.
TLIC_CODES = [
    (
        MIPS_BY_STATUS,
        {
            "regular": "58 CSO 4.5% MOD CRVM CNF (81-88)",
            "eti": "58 CET 4.5% CNF (81-88)",
            "rpu": "58 CSO 4.5% CNF (81-88)",
        },
    ),
    (MIPS_PAID, {"any": "58 CSO 4.5% CNF (81-88)"}),
    (
        SCHD,
        {
            "regular": "80 CSO 4% MOD CRVM CNF (88-91)",
            "eti": "80 CET 4% NLP CNF (86-89)",
            "rpu": "80 CSO 4% MOD CRVM CNF (88-91)",
        },
    ),
    (FLEX, {"CSO80": "80 CSO 4% CNF (86-03)", "CET80": "80 CET 4% NLP CNF (86-89)"}),
    (
        ESTI,
        {"before 1995": "80 CSO 5% CNF (93-94)", "from 1995": "80 CSO 4.5% CNF (95-01)"},
    ),
]

# Name of the same code in the second legal entity.
TFLIC_NAMES = {
    "58 CET 4.5% CNF (81-88)": "58 CET 4.5% ANB NL CNF (81-88)",
    "58 CSO 4.5% CNF (81-88)": "58 CSO 4.5% ANB NL CNF (81-88)",
    "58 CSO 4.5% MOD CRVM CNF (81-88)": "58 CSO 4.5% ANB MOD CRVM CNF (81-88)",
    "80 CET 4% NLP CNF (86-89)": "80 CET 4% ANB NL CNF (86-89)",
    "80 CSO 4% CNF (86-03)": "80 CSO 4% ANB NL CNF (86-01)",
    "80 CSO 4% MOD CRVM CNF (88-91)": "80 CSO 4% ANB MOD CRVM CNF (88-91)",
}

# Statutory company numbers of the legal entities.
TLIC_COMPANIES = [2, 3]
TFLIC_COMPANIES = [4, 5]

PARAMETERS = {
    "plan_code": "STRING",
    "moses_plan_code": "STRING",
    "company_code": "STRING",
    "issue_year": "INT",
    "med_flag": "STRING",
    "era": "STRING",
    "lapse_status": "STRING",
}


def _one_of(value: str, options: list) -> str:
    return f"{value} IN (" + ", ".join(f"'{o}'" for o in options) + ")"


def mortality_basis_sql(args: dict[str, str]) -> str:
    """SQL expression for the mortality table a policy is valued on."""
    paid = f"{args['med_flag']} = 'P'"
    moses = args["moses_plan_code"]
    return f"""CASE
        WHEN {paid} AND ({moses} = 'PRM5' OR ({moses} = 'PRM6' AND {args['era']} = '0')) THEN 'CET80'
        WHEN {moses} IN ('PRM3', 'PRM4') AND {args['plan_code']} <> 'SCHD'
            THEN if({args['lapse_status']} = 'eti', 'CET58', 'CSO58')
        ELSE 'CSO80' END"""


def _map_sql(entries: dict[str, str]) -> str:
    return "map(" + ", ".join(f"'{k}', '{v}'" for k, v in entries.items()) + ")"


def stat_code_sql(args: dict[str, str]) -> str:
    """SQL expression for the code; ``args`` maps each parameter to SQL text.

    Two lookups in constant maps: they generate little code, where nested
    branches over all plans would make a method too long to be compiled.
    """
    plan, year = args["plan_code"], args["issue_year"]
    decider = f"""CASE
        WHEN {_one_of(plan, FLEX)} THEN {mortality_basis_sql(args)}
        WHEN {_one_of(plan, ESTI)} THEN
            if({year} IS NULL, NULL, if({year} < 1995, 'before 1995', 'from 1995'))
        WHEN {_one_of(plan, MIPS_PAID)} THEN 'any'
        ELSE {args['lapse_status']} END"""
    codes = {
        f"{plan_code}:{decided}": code
        for plans, by_decider in TLIC_CODES
        for plan_code in plans
        for decided, code in by_decider.items()
    }
    first_entity = {code: code for code in codes.values()}
    names = {
        f"{company}:{code}": name
        for companies, renamed in ((TLIC_COMPANIES, first_entity), (TFLIC_COMPANIES, TFLIC_NAMES))
        for company in companies
        for code, name in renamed.items()
    }
    code = f"try_element_at({_map_sql(codes)}, concat({plan}, ':', {decider}))"
    return f"try_element_at({_map_sql(names)}, concat({args['company_code']}, ':', {code}))"


def stat_code(columns: dict[str, str]) -> Column:
    """The code as a column; ``columns`` maps each parameter to a column name."""
    return F.expr(stat_code_sql({p: f"`{columns[p]}`" for p in PARAMETERS}))


def mortality_basis(columns: dict[str, str]) -> Column:
    return F.expr(mortality_basis_sql({p: f"`{columns[p]}`" for p in PARAMETERS}))


def register_stat_code(spark: SparkSession, name: str = "map_stat_code") -> None:
    """Offer the mapping as a SQL function of the session."""
    parameters = ", ".join(f"{p} {sql_type}" for p, sql_type in PARAMETERS.items())
    body = stat_code_sql({p: p for p in PARAMETERS})
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS STRING RETURN {body}"
    )
