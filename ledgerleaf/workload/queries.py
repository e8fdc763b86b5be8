"""Every operator as a query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions.names import quoted, standard_name_of, standardize_columns
from ledgerleaf.functions.stat_code import (
    PARAMETERS,
    mortality_basis,
    register_stat_code,
    stat_code,
)
from ledgerleaf.functions.text import LINE_BREAK, lcs_length, lcs_text
from ledgerleaf.operators import best_match, coverage, mapping
from ledgerleaf.operators.filters import slice_filter
from ledgerleaf.plans import notes, policies, profile, reserves, scenario_pack, slicing, snapshots
from ledgerleaf.plans import valuation as val
from ledgerleaf.scratch import scratch_path, settle
from ledgerleaf.sources import csv, dbf, tables
from ledgerleaf.sources.load_once import load_once
from ledgerleaf.workload import frames

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(column: str, digits: int = 2) -> Column:
    return F.round(quoted(column).cast("double"), digits).alias(column.replace(".", "_"))


def _amounts(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """The other columns, and ``columns`` as rounded doubles; dots become underscores."""
    others = [quoted(c).alias(c.replace(".", "_")) for c in df.columns if c not in columns]
    return df.select(*others, *[_rounded(c, digits) for c in columns])


# --- reports -----------------------------------------------------------------

BY_FLAG = slicing.Report(("l_returnflag",), ("quantity", "price"))
BY_FLAG_AND_STATUS = slicing.Report(
    ("l_returnflag", "l_linestatus"), ("quantity", "price", "rebate")
)


@query
def slice_dice_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = slicing.slice_and_dice(frames.positions(spark, sf_dir), BY_FLAG)
    return _amounts(report, list(BY_FLAG.dice))


@query
def slice_dice_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.positions(spark, sf_dir)
    report = slicing.slice_and_dice(rows, BY_FLAG_AND_STATUS, F.col("ship_year") >= 1998)
    return _amounts(report, list(BY_FLAG_AND_STATUS.dice), 4)


@query
def slice_dice_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both reports from one pass over the rows."""
    results = slicing.all_reports(
        frames.positions(spark, sf_dir), [BY_FLAG, BY_FLAG_AND_STATUS]
    )
    both = [
        _amounts(result, list(report.dice), 4).withColumn("report", F.lit(number))
        for number, (report, result) in enumerate(
            zip([BY_FLAG, BY_FLAG_AND_STATUS], results, strict=True), start=1
        )
    ]
    return both[0].unionByName(both[1], allowMissingColumns=True)


# --- cash flows --------------------------------------------------------------


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cash flows with their discount factors, under standard names.

    The scenarios are stored, so that the join knows their size.
    """
    scenarios = settle(frames.scenarios(spark, sf_dir), "scenarios")
    return val.join_scenarios(
        val.load_cash_flows(frames.cash_flows(spark, sf_dir), frames.WHOLE_VALUATION),
        val.load_scenarios(scenarios, frames.WHOLE_VALUATION),
    )


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cash flows added up by scenario and month, with their discount factors."""
    grid, _ = val.valuation_grid(
        frames.cash_flows(spark, sf_dir),
        frames.scenarios(spark, sf_dir),
        frames.WHOLE_VALUATION,
        [],
    )
    return grid


FLOWS = frames.VALUATION.flows


@query
def cf_slice_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = val.load_cash_flows(frames.cash_flows(spark, sf_dir), frames.VALUATION)
    return _amounts(flows, FLOWS, 4)


@query
def cf_scenario_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(_detail(spark, sf_dir), [*FLOWS, "discount_factor"], 8)


@query
def cf_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = val.load_cash_flows(frames.cash_flows(spark, sf_dir), frames.WHOLE_VALUATION)
    grouped = val.group_flows(flows, frames.VALUATION.groupings)
    return _amounts(grouped, [*FLOWS, *frames.GROUPED_FLOWS], 4)


@query
def cf_ess_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = val.ess_weights(_detail(spark, sf_dir))
    return weighted.select("scenario_no", "t", _rounded("benefits", 4), _rounded("ess_weights", 9))


@query
def cf_ess(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid, flows = val.valuation_grid(
        frames.cash_flows(spark, sf_dir), frames.scenarios(spark, sf_dir), frames.WHOLE_VALUATION
    )
    return _amounts(val.ess_flows(grid, flows), [*flows, "discount_factor"], 6)


@query
def cf_with_ess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows and the rows of scenario -1."""
    both = val.with_ess(_detail(spark, sf_dir), FLOWS)
    amounts = _amounts(both, [*FLOWS, "ess_weights"], 8)
    return _amounts(amounts, ["discount_factor"], 12)


@query
def cf_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(val.present_values(_grid(spark, sf_dir), FLOWS), FLOWS)


@query
def cf_bel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole valuation: present values and best estimates per scenario."""
    result = val.cash_flow_valuation(
        frames.cash_flows(spark, sf_dir), frames.scenarios(spark, sf_dir), frames.VALUATION
    )
    return _amounts(result, [c for c in result.columns if c != "scenario_no"])


@query
def calc_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = val.present_value_vector(_grid(spark, sf_dir), FLOWS, "discount_factor")
    return _amounts(vector, FLOWS)


@query
def std_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard names of values, and of the columns themselves."""
    orders = frames.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("O/Order Key (*)"),
        F.col("o_orderpriority").alias(" O_Priority – Text "),
    )
    return standardize_columns(orders, {"O/Order Key (*)": "Order KEY"}).withColumn(
        "std_priority", standard_name_of(F.concat(F.lit(" ("), F.col("o_priority_text"), F.lit(")")))
    )


# --- mapping and coverage ----------------------------------------------------


@query
def regex_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = frames.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return mapping.regex_join(customers, frames.key_patterns(spark), "c_name", "pattern")


@query
def pattern_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns that fix text in the middle, after a class, or in alternatives."""
    customers = frames.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    patterns = frames.supplier_patterns(spark, sf_dir)
    return mapping.regex_join(customers, patterns, "c_name", "pattern")


@query
def wildcard_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_with_wildcard(
        frames.cells(spark, sf_dir), frames.cell_mapping(spark, sf_dir)
    )


COMBO_TAGS = ["c_mktsegment", "c_nationkey", "balance_band"]


def _customer_combos(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as used combinations; those with an urgent finished order define them."""
    customers = frames.table(spark, sf_dir, "customer").withColumn(
        "balance_band",
        F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 1000).cast("int")),
    )
    orders = frames.table(spark, sf_dir, "orders").where(
        slice_filter({"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})
    )
    served = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return customers, served


@query
def combo_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    used, defined = _customer_combos(spark, sf_dir)
    return coverage.missing_combos(
        coverage.combos(used, COMBO_TAGS), coverage.combos(defined, COMBO_TAGS)
    )


@query
def combo_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    used, defined = _customer_combos(spark, sf_dir)
    forward = coverage.covers_all(
        coverage.combos(used, COMBO_TAGS), coverage.combos(defined, COMBO_TAGS)
    )
    backward = coverage.covers_all(
        coverage.combos(defined, COMBO_TAGS), coverage.combos(used, COMBO_TAGS)
    )
    return forward.withColumn("direction", F.lit("used in defined")).unionByName(
        backward.withColumn("direction", F.lit("defined in used"))
    )


@query
def coverage_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    used, defined = _customer_combos(spark, sf_dir)
    groups = {"fad": COMBO_TAGS, "com": COMBO_TAGS[:2], "stat": COMBO_TAGS[1:]}
    return coverage.check_coverage(used, defined, groups)


@query
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        mapping.literal_map(F.col("l_linenumber"), profile.ACTIONS).alias("action"),
    )


@query
def row_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.add_policy_info(frames.policy_keys(spark, sf_dir), strict=False)


# --- batch profile -----------------------------------------------------------


@query
def batch_started(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.started_batches(
        frames.batches(spark, sf_dir), profile.clean_log(frames.batch_log(spark, sf_dir))
    )


def _time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


@query
def batch_start_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = profile.clean_log(frames.batch_log(spark, sf_dir))
    starts = profile.batch_starts(frames.batches(spark, sf_dir), log)
    return starts.select("Id", "Name", _time_text("start_time"))


@query
def batch_is_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.flag_macros(
        frames.batches(spark, sf_dir), frames.batch_step_rows(spark, sf_dir)
    )


@query
def batch_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = profile.batch_spans(profile.clean_log(frames.batch_log(spark, sf_dir)))
    return spans.select("Id", _time_text("batch_start"), _time_text("batch_finish"), "n_starts")


@query
def step_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = profile.batch_steps(
        frames.batch_step_rows(spark, sf_dir), frames.batches(spark, sf_dir)
    )
    return profile.step_offsets(steps)


def _profile_inputs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [
        frames.batch_log(spark, sf_dir),
        frames.batches(spark, sf_dir),
        frames.batch_step_rows(spark, sf_dir),
    ]


@query
def batch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.batch_profile(*_profile_inputs(spark, sf_dir)).select(
        "batch_id",
        "step_ref",
        _rounded("event_id", 4),
        "event_name",
        _time_text("event_start"),
        _time_text("event_finish"),
        "duration_in_seconds",
    )


@query
def trace_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.to_trace(settle(profile.batch_events(*_profile_inputs(spark, sf_dir))))


@query
def trace_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trace of all batches as one JSON array in one file, read back."""
    trace = profile.to_trace(settle(profile.batch_events(*_profile_inputs(spark, sf_dir))))
    path = scratch_path(spark, "trace") + ".json"
    profile.write_trace_array(trace, path)
    return profile.read_trace_array(spark, path, trace.schema)


# --- reserves ----------------------------------------------------------------

POLICY_COLUMNS = ["l_orderkey", "l_linenumber"]


@query
def stat_code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reserves.add_policy_attributes(frames.policies(spark, sf_dir))
    return rows.select(
        *POLICY_COLUMNS,
        mortality_basis(reserves.STAT_CODE_COLUMNS).alias("mortality_basis"),
        stat_code(reserves.STAT_CODE_COLUMNS).alias("stat_code"),
    )


@query
def stat_code_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mapping called as a SQL function."""
    register_stat_code(spark)
    rows = reserves.add_policy_attributes(frames.policies(spark, sf_dir))
    arguments = [quoted(reserves.STAT_CODE_COLUMNS[p]) for p in PARAMETERS]
    return rows.groupBy(F.call_function("map_stat_code", *arguments).alias("stat_code")).agg(
        F.count(F.lit(1)).alias("n_policies")
    )


@query
def mortality_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reserves.add_policy_attributes(frames.policies(spark, sf_dir))
    names = {
        column: parameter
        for parameter, column in reserves.STAT_CODE_COLUMNS.items()
        if parameter in reserves.MORTALITY_BASIS_KEYS
    }
    return reserves.join_mortality_basis(
        rows.withColumnsRenamed(names).select(*POLICY_COLUMNS, *reserves.MORTALITY_BASIS_KEYS)
    )


# Fields that hold a multiple of the tax factor.
FACTORED = ["Tax_2001D1R", "Tax_200DD1R", "KC4_tax_ga", "KC4_tax_gmdb_reserve"]


def _published_amounts(digits: int) -> list[Column]:
    """All published fields as doubles, the factored ones rounded."""
    return [
        _rounded(c, digits) if c in FACTORED else F.col(c).cast("double").alias(c)
        for c in reserves.SUMMED_FIELDS
    ]


@query
def extended_reserves(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reserves.extended_reserves(frames.policies(spark, sf_dir))
    labels = ["lapse_status", "legal_entity", "JE_center", "Tax_center", "ex5_stat_code"]
    own = [
        "accrued_charges",
        "unearned_coi",
        "stat_eti_reserve",
        "tax_eti_reserve",
        "stat_rpu_reserve",
        "tax_rpu_reserve",
    ]
    return rows.select(
        *POLICY_COLUMNS,
        *labels,
        *[F.col(c).cast("double").alias(c) for c in own],
        *_published_amounts(digits=4),
    )


@query
def reserve_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of whole numbers are exact; those of the tax factor depend on the order of rows."""
    summary = reserves.reserve_summary(frames.policies(spark, sf_dir))
    return summary.select("legal_entity", *_published_amounts(digits=-3))


@query
def reserve_sums_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as they are, sums rounded once: equal to the last bit under any order of rows."""
    return reserves.exact_reserve_summary(frames.policies(spark, sf_dir, lambda amount: amount))


# --- scenario pack and tables ------------------------------------------------


def _pack(spark: SparkSession, sf_dir: str) -> scenario_pack.ScenarioPack:
    flows = frames.cash_flows(spark, sf_dir).select(
        F.col("ScenarioNumber").alias("ScnNumber"),
        F.col("ProjMth").alias("RowNo"),
        (F.col("ProjMth") - 60).alias("Step"),
        F.col("Benefits").alias("death"),
    )
    discounts = frames.scenarios(spark, sf_dir).toDF("ScnNumber", "ProjMonth", "Discount_Factor")
    flows.createOrReplaceTempView("pack_cash_flows")
    settle(discounts, "discounts").createOrReplaceTempView("pack_discounts")
    return scenario_pack.scenario_pack(spark, "pack_cash_flows", "pack_discounts")


@query
def pack_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(_pack(spark, sf_dir).joined, ["death", "Discount_Factor"], 8)


@query
def pack_filtered_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(_pack(spark, sf_dir).total_death, ["total_death"], 4)


@query
def pack_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pack(spark, sf_dir).discount_count


@query
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some columns and some rows of a named table."""
    frames.table(spark, sf_dir, "customer").createOrReplaceTempView("scan_customer")
    return tables.read_table(
        spark,
        "scan_customer",
        ["c_custkey", "c_name", "c_acctbal"],
        {"c_mktsegment": "BUILDING", "c_nationkey": 7},
    )


@query
def query_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement with values and a table name as parameters."""
    frames.table(spark, sf_dir, "orders").createOrReplaceTempView("text_orders")
    text = """
        SELECT o_orderpriority, count(*) AS n_orders FROM IDENTIFIER(:orders)
        WHERE o_orderstatus = :status AND o_totalprice > :least GROUP BY o_orderpriority
    """
    args = {"orders": "text_orders", "status": "F", "least": 1000.0}
    return tables.run_query_text(spark, text, args)


@query
def top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = frames.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


# --- files -------------------------------------------------------------------


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = frames.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    csv.write_csv(orders, path)
    return csv.read_csv(spark, path, orders.schema, quoted_newlines=False)


@query
def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes and line breaks."""
    turns = frames.table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "turns-csv")
    csv.write_csv(turns, path)
    return csv.read_csv(spark, path, turns.schema, range_bytes=csv.RANGE_BYTES)


@query
def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, table_path = scratch_path(spark, "load-csv"), scratch_path(spark, "load-table")
    csv.write_csv(frames.table(spark, sf_dir, "customer"), path)
    name = "bulk_" + table_path.rsplit("-", 1)[1]
    schema = frames.table(spark, sf_dir, "customer").schema
    return csv.csv_to_table(spark, path, name, schema, path=table_path, range_bytes=csv.RANGE_BYTES)


@query
def csv_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as it is, with blanks and line breaks at both ends, in quotes, and none."""
    text = F.col("text")
    texts = frames.table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.concat(F.lit("  "), text, F.lit(" \n")).alias("padded"),
        F.concat(F.lit('"\\'), text, F.lit('\\"')).alias("in_quotes"),
        F.lit("").alias("empty"),
        F.lit(None).cast("string").alias("missing"),
    )
    path = scratch_path(spark, "blanks-csv")
    csv.write_csv(texts, path)
    return csv.read_csv(spark, path, texts.schema, range_bytes=csv.RANGE_BYTES)


@query
def csv_ranges_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks inside quotes, each file read in ranges of a megabyte."""
    docs = frames.table(spark, sf_dir, "documents")
    path = scratch_path(spark, "texts-csv")
    csv.write_csv(docs, path)
    return csv.read_csv(spark, path, docs.schema, range_bytes=1 << 20)


@query
def bulk_load_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted line breaks in a bulk load, twice into the same table."""
    turns = frames.table(spark, sf_dir, "conversations")
    path, table_path = scratch_path(spark, "load-csv"), scratch_path(spark, "load-table")
    csv.write_csv(turns, path)
    name = "bulk_" + table_path.rsplit("-", 1)[1]
    csv.csv_to_table(spark, path, name, turns.schema, path=table_path, range_bytes=csv.RANGE_BYTES)
    return csv.csv_to_table(spark, path, name, range_bytes=csv.RANGE_BYTES)


@query
def bulk_load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that is tried twice, and once more with files that were loaded before."""
    customers = frames.table(spark, sf_dir, "customer")
    path, table_path = scratch_path(spark, "load-csv"), scratch_path(spark, "load-table")
    positive = F.coalesce(F.col("c_acctbal") >= 0, F.lit(False))
    csv.write_csv(customers.where(positive), f"{path}/first")
    csv.write_csv(customers.where(~positive), f"{path}/second")
    name = "bulk_" + table_path.rsplit("-", 1)[1]
    for folders in (["first"], ["first"], ["first", "second"]):
        files = [f"{path}/{folder}" for folder in folders]
        loaded = load_once(spark, files, name, customers.schema, path=table_path)
    return loaded


def _dbf_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ID"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("CUST"),
        F.col("o_totalprice").alias("PRICE"),
        F.col("o_orderpriority").alias("PRIORITY"),
        (F.col("o_orderstatus") == "F").alias("DONE"),
        F.to_date("o_orderdate").alias("ORDERED"),
    )


@query
def dbf_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-dbf")
    dbf.write_dbf(_dbf_orders(spark, sf_dir), path)
    return dbf.read_dbf(spark, path).withColumn("ORDERED", F.col("ORDERED").cast("string"))


DBF_SPECS = {
    "ID": {"type": "N", "length": 12, "decimal": 0},
    "CUST": {"type": "N", "length": 10, "decimal": 0},
    "PRICE": {"type": "F", "length": 14, "decimal": 2},
    "PRIORITY": {"type": "C", "length": 6},
    "DONE": {"type": "L", "length": 1},
    "ORDERED": {"type": "D", "length": 8},
}


@query
def dbf_custom_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given widths; texts are cut to theirs."""
    path = scratch_path(spark, "orders-dbf")
    dbf.write_dbf(_dbf_orders(spark, sf_dir), path, DBF_SPECS)
    return dbf.read_dbf(spark, path).withColumn("ORDERED", F.col("ORDERED").cast("string"))


@query
def dbf_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number fields that hold text, and records flagged as deleted."""
    orders = frames.table(spark, sf_dir, "orders")
    digit = F.substring("o_orderpriority", 1, 1)
    rows = orders.select(
        F.col("o_orderkey").alias("ID"),
        F.when(F.col("o_orderstatus") == "F", digit).otherwise(F.col("o_orderpriority")).alias("LEVEL"),
    )
    stored = [dbf.DbfField("ID", "N", 18), dbf.DbfField("LEVEL", "C", 16)]
    claimed = [stored[0], dbf.DbfField("LEVEL", "N", 16)]
    deleted = F.col("LEVEL") == "5"
    records = dbf.encode_records(rows, stored, deleted)
    path = scratch_path(spark, "levels-dbf")
    dbf.write_records(records, claimed, path)
    return dbf.read_dbf(spark, path, mode=dbf.PERMISSIVE)


CATALOG_TABLES = {
    "nation": {"n_nationkey": "ID", "n_name": "NAME", "n_regionkey": "REGION"},
    "customer": {"c_custkey": "ID", "c_name": "NAME", "c_acctbal": "BALANCE"},
}


@query
def dbf_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and numbers of records of two tables, from the headers of all their files."""
    root = scratch_path(spark, "catalog-dbf")
    for name, columns in CATALOG_TABLES.items():
        rows = frames.table(spark, sf_dir, name).select(list(columns)).withColumnsRenamed(columns)
        dbf.write_dbf(rows, f"{root}/{name}")
    described = dbf.dbf_catalog(spark, f"{root}/*")
    folder = F.element_at(F.split("path", "/"), -2)
    shape = ["field_no", "field_name", "field_type", "field_length", "field_decimals"]
    return described.groupBy(folder.alias("table_name"), *shape).agg(
        F.sum("record_count").alias("record_count")
    )


@query
def max_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = frames.table(spark, sf_dir, "documents")
    return dbf.max_widths(documents, ["text", "lang", "source"])


@query
def dbf_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records an explicit limit lets through."""
    path = scratch_path(spark, "limit-dbf")
    dbf.write_dbf(_dbf_orders(spark, sf_dir), path)
    return dbf.read_dbf(spark, path, limit=100).agg(F.count("*").alias("n_records"))


@query
def reports_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files, read back."""
    folder = scratch_path(spark, "reports")
    report = slicing.Report(BY_FLAG.slice, BY_FLAG.dice, f"{folder}/by-flag")
    slicing.write_reports(frames.positions(spark, sf_dir), [report])
    return _amounts(csv.read_csv(spark, report.output_path), list(report.dice))


# --- texts -------------------------------------------------------------------


@query
def latest_lien(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes.latest_lien(frames.lien_notes(spark, sf_dir))


@query
def latest_lien_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes.latest_lien_of_lines(frames.lien_lines(spark, sf_dir))


@query
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document."""
    lines = F.posexplode(F.split("text", LINE_BREAK)).alias("line_no", "line")
    return frames.table(spark, sf_dir, "documents").select("doc_id", lines)


@query
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = frames.modules(spark, sf_dir)
    return snapshots.snapshot_diff(old, new, force=False, exclude="^MODULE.*7$")


@query
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = frames.modules(spark, sf_dir)
    diff = snapshots.snapshot_diff(old, new, force=True, exclude="^MODULE.*7$")
    merged = snapshots.merge_snapshot(old, new, diff)
    return merged.select("name", F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def lcs_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.table(spark, sf_dir, "part").select(
        "p_partkey", lcs_length(F.col("p_name"), F.lower("p_type")).alias("lcs_length")
    )


@query
def lcs_common_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.table(spark, sf_dir, "part").select(
        "p_partkey", lcs_text(F.col("p_name"), F.lower("p_type")).alias("lcs")
    )


@query
def lcs_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier of its nation whose name is most like that of a customer."""
    customers = frames.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    suppliers = frames.table(spark, sf_dir, "supplier")
    best = best_match.lcs_best(
        customers, suppliers, "c_custkey", "c_name", "s_suppkey", "s_name", "c_nationkey", "s_nationkey"
    )
    return best.select("c_custkey", "best_key", "best_length")


@query
def lcs_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation against the next one, whole texts."""
    turns = frames.table(spark, sf_dir, "conversations")
    replies = turns.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    return turns.join(replies, ["conv_id", "turn"]).select(
        "conv_id", "turn", lcs_length(F.col("text"), F.col("reply")).alias("lcs_length")
    )
