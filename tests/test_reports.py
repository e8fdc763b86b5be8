import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions.stat_code import PARAMETERS, register_stat_code, stat_code
from ledgerleaf.plans import reserves, slicing


@pytest.fixture(scope="module")
def policies(spark):
    schema = (
        "`Cell Name ALPHA` string, `Plan Code` string, `MoSes Plan Code` string, med_flag string, era string,"
        " `Statutory Company` int, `Iss Year` int, `UL Seg Fund/ Sep Acct Balance` double, UDV31_GID double,"
        " `Accrued Admin Charge` double, `Accrued Asset Credit` double, `Accrued Net Loan Cost` double,"
        " `Accrued COI` double, `Accrued Load` double, `Reserve details - AG37 AALR` double,"
        " `Reserve details - AG37 OYT Res` double, `Stat Res - Gross reserve` double,"
        " `Stat Res - Gross deficiency reserve` double, `Tax Res - Gross reserve` double"
    )
    rows = [
        ("I_x", "MSA", "PRM5", "P", "_", 2, 1989, 100.0, 5.0, 1.0, 2.0, 3.0, 4.0, 6.0, 9.0, 8.0, 150.0, 7.0, 140.0),
        ("U_y", "EIS", "PRM2", None, "0", 4, 1995, 100.0, 5.0, 1.0, 2.0, 3.0, 4.0, 6.0, 8.0, 9.0, 150.0, 7.0, 140.0),
        ("zU_", None, "PRM3", "P", "0", 9, None, 100.0, None, 1.0, 2.0, 3.0, 4.0, None, None, 9.0, 150.0, 7.0, 140.0),
    ]
    return spark.createDataFrame(rows, schema)


def test_policy_reserves(policies):
    first, second, third = reserves.extended_reserves(policies).collect()
    assert (first.lapse_status, first.legal_entity, first.ex5_stat_code) == ("eti", "TLIC", "80 CET 4% NLP CNF (86-89)")
    assert (first.accrued_charges, first.unearned_coi) == (16, 0)
    assert (first.stat_gmdb_reserve, first.tax_gmdb_reserve) == (9, pytest.approx(9 * 0.9281))
    assert (first.stat_eti_reserve, first.stat_rpu_reserve, first.tax_eti_reserve) == (150, 0, 0)
    assert (first.KC4_stat_sa, first.KC4_total_stat, first.KC4_total_tax) == (84, 139, 129)
    assert first.JE_2001D1R == first.ex5_A_direct == 150 - 100 - 9 - 7 + 0 + 5
    assert first.Tax_2001D1R == pytest.approx(140 - 100 - 9 * 0.9281 + 5)
    assert (first.JE_center, first.Tax_center) == ("101M0000", "101M0000")
    assert (second.lapse_status, second.legal_entity, second.ex5_stat_code) == ("rpu", "TFLIC", None)
    assert (second.accrued_charges, second.unearned_coi, second.stat_gmdb_reserve) == (6, -10, 9)
    assert (third.lapse_status, third.legal_entity, third.ex5_stat_code) == ("regular", "undefined", None)
    assert (third.accrued_charges, third.stat_gmdb_reserve, third.KC4_total_stat) == (None, 9, None)


def test_summary(policies):
    rows = reserves.reserve_summary(policies).collect()
    assert [r.legal_entity for r in rows] == ["undefined", "TLIC", "TFLIC"]
    assert len(reserves.SUMMED_FIELDS) == 35
    assert rows[0].KC4_total_stat is None and rows[0].JE_2001C1R == 0
    assert rows[1].KC4_total_stat == 139


def test_summary_has_one_shuffle_before_the_sort(policies):
    plan = reserves.reserve_summary(policies)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and "rangepartitioning" in exchanges[0]


def test_exact_summary_is_like_the_plain_one(policies):
    exact, plain = reserves.exact_reserve_summary(policies), reserves.reserve_summary(policies)
    assert exact.columns == plain.columns
    for mine, theirs in zip(exact.collect(), plain.collect(), strict=True):
        for name, value in theirs.asDict().items():
            assert mine[name] == value or mine[name] == pytest.approx(value, rel=1e-12)


def test_exact_summary_of_many_rows_under_any_partitioning(policies):
    copies = policies.crossJoin(policies.sparkSession.range(500)).withColumn(
        "UDV31_GID", F.sin("id") * F.pow(F.lit(10.0), F.pmod("id", F.lit(12)))
    )
    one, many = (
        [tuple(r) for r in reserves.exact_reserve_summary(copies.repartition(n)).collect()] for n in (1, 9)
    )
    assert one == many


CODES = [
    (("MSA", "PRM5", "2", 1989, "P", "_", "regular"), "80 CET 4% NLP CNF (86-89)"),
    (("MSA", "PRM5", "5", 1989, "P", "_", "regular"), "80 CET 4% ANB NL CNF (86-89)"),
    (("MSA", "PRM5", "1", 1989, "P", "_", "regular"), None),
    (("MSA", "PRM5", "2", 1989, None, "_", "regular"), "80 CSO 4% CNF (86-03)"),
    (("P7J", "PRM6", "3", 1989, "P", "0", "eti"), "80 CET 4% NLP CNF (86-89)"),
    (("P7J", "PRM6", "3", 1989, "P", "1", "eti"), "80 CSO 4% CNF (86-03)"),
    (("P7J", "PRM4", "3", 1989, "P", "0", "eti"), None),
    (("7PY", "x", "2", 1985, "P", "0", "regular"), "58 CSO 4.5% MOD CRVM CNF (81-88)"),
    (("7PY", "x", "4", 1985, "P", "0", "rpu"), "58 CSO 4.5% ANB NL CNF (81-88)"),
    (("7PY", "x", "4", 1985, "P", "0", "other"), None),
    (("S83", "x", "2", None, None, None, None), "58 CSO 4.5% CNF (81-88)"),
    (("SP1", "x", "2", 1988, "P", "0", "rpu"), "80 CSO 4% MOD CRVM CNF (88-91)"),
    (("EIJ", "x", "2", 1994, "P", "0", "rpu"), "80 CSO 5% CNF (93-94)"),
    (("EIJ", "x", "2", 1995, "P", "0", "rpu"), "80 CSO 4.5% CNF (95-01)"),
    (("EIJ", "x", "2", None, "P", "0", "rpu"), None),
    (("EIJ", "x", "4", 1995, "P", "0", "rpu"), None),
    ((None, "x", "2", 1995, "P", "0", "rpu"), None),
]


def test_stat_code_as_column_and_as_function(spark):
    schema = ", ".join(f"{name} {kind}" for name, kind in PARAMETERS.items())
    df = spark.createDataFrame([row for row, _ in CODES], schema)
    register_stat_code(spark)
    rows = df.select(
        stat_code({p: p for p in PARAMETERS}).alias("column"),
        F.call_function("map_stat_code", *[F.col(p) for p in PARAMETERS]).alias("function"),
    ).collect()
    wanted = [code for _, code in CODES]
    assert [r.column for r in rows] == wanted
    assert [r.function for r in rows] == wanted


REPORTS = {
    "queries": [
        {"output_path": "one", "slice": ["entity"], "dice": ["base", "gmdb"]},
        {"output_path": "two", "slice": ["entity", "stat code"], "dice": ["gmdb"]},
        {"output_path": "three", "slice": ["year"], "dice": ["base"]},
    ]
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [("b", "x", 1, 1.0, None), ("a", "x", 1, 2.0, None), ("a", "y", 2, 3.0, 4.0), (None, "y", 2, 5.0, 6.0)]
    return spark.createDataFrame(data, "entity string, `stat code` string, year int, base double, gmdb double")


def test_reports(rows):
    reports = slicing.reports_from(REPORTS)
    alone = [slicing.slice_and_dice(rows, r).collect() for r in reports]
    shared = [df.collect() for df in slicing.all_reports(rows, reports)]
    assert alone == shared
    assert [tuple(r) for r in alone[0]] == [(None, 5.0, 6.0), ("a", 5.0, 4.0), ("b", 1.0, None)]
    assert slicing.slice_and_dice(rows, reports[2], F.col("year") > 1).count() == 1
    with pytest.raises(ValueError, match="nope"):
        slicing.slice_and_dice(rows, slicing.Report(("nope",), ("base",)))


def test_reports_as_csv(spark, rows, tmp_path):
    reports = [
        slicing.Report(r.slice, r.dice, str(tmp_path / r.output_path)) for r in slicing.reports_from(REPORTS)
    ]
    slicing.write_reports(rows, reports)
    back = spark.read.csv(str(tmp_path / "two"), header=True).collect()
    assert sorted((r["entity"] or "", r["stat code"], r["gmdb"]) for r in back) == [
        ("", "y", "6.0"), ("a", "x", None), ("a", "y", "4.0"), ("b", "x", None),
    ]
    with pytest.raises(ValueError, match="output_path"):
        slicing.write_reports(rows, [slicing.Report(("year",), ("base",))])
