"""The queries as plain SQL over the same tables, written for DuckDB.

They are worded from the definitions of the results, row by row and without the
shortcuts the jobs take, so that they check them independently.
"""

from __future__ import annotations

from ledgerleaf.workload.frames import MOSES_CODES, PLAN_CODES

ORACLE: dict[str, str] = {}

# Codes of log lines, names of actions, rows of the mortality table.
START_CODE, FINISH_CODE = 8169, 7473
ACTIONS = {
    0: "Initialize",
    1: "Load",
    2: "Map",
    3: "Run batch",
    4: "Run query",
    5: "Export seriatim",
    6: "Update assumptions",
    9: "Build risk classes",
    10: "Remove cells",
}
MORTALITY_BASIS_ROWS = [
    ("MSA", "PRM5", "P", "_", "regular", "CET80"),
    ("P6S", "PRM6", "P", "0", "regular", "CET80"),
    ("P6J", "PRM6", "P", "0", "regular", "CET80"),
    ("P7S", "PRM6", "P", "0", "regular", "CET80"),
    ("P7J", "PRM6", "P", "0", "regular", "CET80"),
    ("P8S", "PRM6", "P", "0", "regular", "CET80"),
    ("P8J", "PRM6", "P", "0", "regular", "CET80"),
]


def _rounded(columns: list[str], digits: int = 2) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in columns)


def _text_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# --- reports -----------------------------------------------------------------

POSITIONS = """positions AS (
    SELECT l_returnflag, l_linestatus, year(l_shipdate) AS ship_year,
        CAST(l_quantity AS DECIMAL(14,2)) AS quantity,
        CAST(l_extendedprice AS DECIMAL(14,2)) AS price,
        CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS rebate
    FROM lineitem)"""

_BY_FLAG = """SELECT l_returnflag, sum(quantity) AS quantity, sum(price) AS price
    FROM positions GROUP BY l_returnflag"""
_BY_BOTH = """SELECT l_returnflag, l_linestatus, sum(quantity) AS quantity, sum(price) AS price,
    sum(rebate) AS rebate FROM positions WHERE {where} GROUP BY l_returnflag, l_linestatus"""

ORACLE["slice_dice_1"] = f"""WITH {POSITIONS}
SELECT l_returnflag, {_rounded(["quantity", "price"])} FROM ({_BY_FLAG}) ORDER BY l_returnflag"""

ORACLE["slice_dice_2"] = f"""WITH {POSITIONS}
SELECT l_returnflag, l_linestatus, {_rounded(["quantity", "price", "rebate"], 4)}
FROM ({_BY_BOTH.format(where="ship_year >= 1998")}) ORDER BY l_returnflag, l_linestatus"""

ORACLE["slice_dice_nested"] = f"""WITH {POSITIONS}
SELECT 1 AS report, l_returnflag, CAST(NULL AS VARCHAR) AS l_linestatus,
    {_rounded(["quantity", "price"], 4)}, CAST(NULL AS DOUBLE) AS rebate FROM ({_BY_FLAG})
UNION ALL
SELECT 2, l_returnflag, l_linestatus, {_rounded(["quantity", "price", "rebate"], 4)}
FROM ({_BY_BOTH.format(where="true")})"""

# --- cash flows --------------------------------------------------------------

FLOWS = ["income_new_business", "income_renewal", "benefits"]
GROUPS = {
    "main_book_premium": "income_new_business + income_renewal",
    "main_book_benefit": "-benefits",
    "main_book_savings_part": "0",
    "main_book_running_cost": "0",
    "main_book_selling_cost": "0",
}
ALL_FLOWS = [*FLOWS, *GROUPS]

ALL_CASH_FLOWS = """all_cash_flows AS (
    SELECT l_linenumber - 1 AS scenario_no,
        CAST((year(l_shipdate) - 1992) * 12 + month(l_shipdate) - 1 AS INTEGER) AS t,
        l_linestatus AS line_status,
        CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(14,2)) ELSE 0 END
            AS income_new_business,
        CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(14,2)) END
            AS income_renewal,
        CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2))
            AS DECIMAL(14,4)) AS benefits
    FROM lineitem)"""

SCENARIOS = """scenarios AS (
    SELECT DISTINCT scenario_no, t, CAST(round(power(1.0e0 + (scenario_no + 2) / 100.0e0,
        -t / 12.0e0), 8) AS DECIMAL(10,8)) AS discount_factor
    FROM all_cash_flows)"""

_GROUP_SQL = ", ".join(f"{sql} AS {name}" for name, sql in GROUPS.items())

DETAIL = f"""{ALL_CASH_FLOWS}, {SCENARIOS},
flows AS (SELECT * FROM all_cash_flows),
detail AS (
    SELECT f.*, {_GROUP_SQL}, s.discount_factor
    FROM flows AS f LEFT JOIN scenarios AS s USING (scenario_no, t))"""

# The slice is the feature of the slice filter and of the whole job only.
SLICED = DETAIL.replace("FROM all_cash_flows),", "FROM all_cash_flows WHERE line_status = 'F'),")


def _ess(flows: list[str]) -> str:
    weighted = ", ".join(
        f"CAST(sum({c} * discount_factor) AS DOUBLE) / CAST(sum(discount_factor) AS DOUBLE) AS {c}"
        for c in flows
    )
    return f"""ess AS (
        SELECT -1 AS scenario_no, t, {weighted},
            CAST(sum(discount_factor) AS DOUBLE) / count(discount_factor) AS discount_factor
        FROM detail WHERE scenario_no BETWEEN 1 AND 1000 GROUP BY t)"""


def _present_values(flows: list[str]) -> str:
    return ", ".join(f"sum({c} * discount_factor) AS {c}" for c in flows)


ORACLE["cf_slice_filter"] = f"""WITH {SLICED}
SELECT scenario_no, t, line_status, {_rounded(FLOWS, 4)} FROM flows"""

ORACLE["cf_scenario_left_join"] = f"""WITH {DETAIL}
SELECT scenario_no, t, line_status, {_rounded([*FLOWS, "discount_factor"], 8)} FROM detail"""

ORACLE["cf_grouped"] = f"""WITH {DETAIL}
SELECT scenario_no, t, line_status, {_rounded(ALL_FLOWS, 4)} FROM detail"""

_WEIGHTED = """weighted AS (
    SELECT *, CASE WHEN scenario_no BETWEEN 1 AND 1000 THEN CAST(discount_factor AS DOUBLE)
        / CAST(sum(CASE WHEN scenario_no BETWEEN 1 AND 1000 THEN discount_factor END)
            OVER (PARTITION BY t) AS DOUBLE) END AS ess_weights
    FROM detail)"""

ORACLE["cf_ess_weights"] = f"""WITH {DETAIL}, {_WEIGHTED}
SELECT scenario_no, t, {_rounded(["benefits"], 4)}, {_rounded(["ess_weights"], 9)} FROM weighted"""

ORACLE["cf_ess"] = f"""WITH {DETAIL}, {_ess(ALL_FLOWS)}
SELECT scenario_no, t, {_rounded([*ALL_FLOWS, "discount_factor"], 6)} FROM ess"""

ORACLE["cf_with_ess"] = f"""WITH {DETAIL}, {_WEIGHTED}, {_ess(FLOWS)}
SELECT scenario_no, t, line_status, {_rounded([*FLOWS, "ess_weights"], 8)},
    {_rounded(["discount_factor"], 12)}
FROM weighted
UNION ALL
SELECT scenario_no, t, NULL, {_rounded(FLOWS, 8)}, NULL, {_rounded(["discount_factor"], 12)}
FROM ess"""

ORACLE["cf_pv"] = f"""WITH {DETAIL}
SELECT scenario_no, {_rounded(FLOWS)}
FROM (SELECT scenario_no, {_present_values(FLOWS)} FROM detail GROUP BY scenario_no)"""

_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ALL_FLOWS)
ORACLE["cf_bel"] = f"""WITH {SLICED}, {_ess(ALL_FLOWS)},
pvs AS (
    SELECT scenario_no, {_DOUBLES}
    FROM (SELECT scenario_no, {_present_values(ALL_FLOWS)} FROM detail GROUP BY scenario_no)
    UNION ALL
    SELECT scenario_no, {_present_values(ALL_FLOWS)} FROM ess GROUP BY scenario_no),
bels AS (
    SELECT *, -main_book_premium + main_book_benefit + main_book_savings_part
        + main_book_running_cost + main_book_selling_cost AS main_book_bel, 0.0e0 AS side_book_bel
    FROM pvs)
SELECT scenario_no, {_rounded([*ALL_FLOWS, "main_book_bel", "side_book_bel"])} FROM bels"""

ORACLE["calc_pv"] = f"""WITH {DETAIL}
SELECT {_rounded(FLOWS)} FROM (SELECT {_present_values(FLOWS)} FROM detail)"""

ORACLE["std_names"] = r"""
SELECT o_orderkey AS order_key, o_orderpriority AS o_priority_text,
    regexp_replace(trim(regexp_replace(lower(' (' || o_orderpriority || ')'),
        '[^0-9a-z_\s]', ' ', 'g')), '\s+', '_', 'g') AS std_priority
FROM orders"""

# --- mapping and coverage ----------------------------------------------------

ORACLE["regex_join"] = """
SELECT c_custkey, c_name, pattern, band
FROM customer JOIN (VALUES ('Customer#0000000[0-4]', 'low'), ('.*7$', 'seven'),
    ('Customer#.*99|Customer#.*00', 'edge'), ('ustomer', 'never')) AS p(pattern, band)
  ON regexp_matches(c_name, '^(?:' || pattern || ')')"""

ORACLE["wildcard_map"] = """
WITH rules AS (
    SELECT DISTINCT '.*' AS brand, p_type AS kind, '[1-9]' AS size FROM part
    UNION ALL SELECT DISTINCT p_brand, '.*', CAST(p_size AS VARCHAR) FROM part
    UNION ALL SELECT * FROM (VALUES ('Brand#1.', 'SMALL', '1.*'),
        ('Brand#2[0-4]', 'LARGE|PROMO', '.*'), ('.*', '.*', '5.')) AS f(brand, kind, size)),
patterns AS (
    SELECT '^(?:^' || brand || '~' || kind || '~' || size || '$)' AS pattern,
        concat_ws('_', 'Premiums', brand, kind, size) AS table_premium,
        concat_ws('_', 'Min', brand, kind, size) AS table_min_premium
    FROM rules)
SELECT p_partkey, p_brand AS tag_brand, p_type AS tag_type, p_size AS tag_size,
    table_premium, table_min_premium
FROM part JOIN patterns
  ON regexp_matches(p_brand || '~' || p_type || '~' || CAST(p_size AS VARCHAR), pattern)"""

COMBOS = """tagged AS (
    SELECT *, CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal / 1000) AS INTEGER) END AS band
    FROM customer),
served AS (
    SELECT * FROM tagged WHERE c_custkey IN (SELECT o_custkey FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'))"""


def _combo(columns: list[str]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in columns)


_TAGS = ["c_mktsegment", "c_nationkey", "band"]


def _missing(columns: list[str], used: str = "tagged", defined: str = "served") -> str:
    text = _combo(columns)
    return f"SELECT {text} AS combo FROM {used} EXCEPT SELECT {text} FROM {defined}"


ORACLE["combo_missing"] = f"WITH {COMBOS} SELECT combo FROM ({_missing(_TAGS)})"

ORACLE["combo_subset"] = f"""WITH {COMBOS}
SELECT count(*) = 0 AS covered, 'used in defined' AS direction FROM ({_missing(_TAGS)})
UNION ALL
SELECT count(*) = 0, 'defined in used' FROM ({_missing(_TAGS, "served", "tagged")})"""

ORACLE["coverage_by_group"] = f"""WITH {COMBOS}
SELECT 'fad' AS assumption_group, combo FROM ({_missing(_TAGS)})
UNION ALL SELECT 'com', combo FROM ({_missing(_TAGS[:2])})
UNION ALL SELECT 'stat', combo FROM ({_missing(_TAGS[1:])})"""

_ACTION_CASES = " ".join(f"WHEN {number} THEN '{name}'" for number, name in ACTIONS.items())

ORACLE["map_lookup"] = f"""
SELECT l_orderkey, l_linenumber, CASE l_linenumber {_ACTION_CASES} END AS action FROM lineitem"""

ORACLE["row_map"] = """
WITH keyed AS (SELECT c_custkey, lower(repeat(substr(c_mktsegment, 1, 1), 3)) AS policy_id FROM customer)
SELECT c_custkey, policy_id, reverse(policy_id) AS lpolicy_id,
    CASE WHEN policy_id = 'aaa' THEN 'CSO80' ELSE 'CET80' END AS stat_code,
    CASE policy_id WHEN 'aaa' THEN 'flex' WHEN 'bbb' THEN 'mips' WHEN 'ccc' THEN 'schd' END AS system
FROM keyed"""

# --- batch profile -----------------------------------------------------------

LOG = f"""log AS (
    SELECT o_orderkey * 10 + 1 AS id, {START_CODE} AS no, o_orderkey AS batch,
        o_orderdate AS ts FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL
    SELECT o_orderkey * 10 + 2, {START_CODE}, o_orderkey, o_orderdate + INTERVAL 30 SECOND
    FROM orders WHERE o_orderstatus <> 'O' AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT o_orderkey * 10 + 3, {FINISH_CODE}, o_orderkey, o_orderdate + INTERVAL 120 SECOND
    FROM orders WHERE o_orderstatus = 'F')"""

BATCHES = """batches AS (
    SELECT o_orderkey AS "Id", 'Order ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS "Name"
    FROM orders)"""

SPANS = f"""spans AS (
    SELECT batch,
        arg_min(ts, id) FILTER (WHERE no = {START_CODE}) AS batch_start,
        arg_min(ts, id) FILTER (WHERE no = {FINISH_CODE}) AS batch_finish,
        count(*) FILTER (WHERE no = {START_CODE}) AS n_starts
    FROM log GROUP BY batch HAVING count(*) FILTER (WHERE no = {START_CODE}) > 0)"""

STEPS = f"""step_rows AS (
    SELECT l_orderkey AS id, l_suppkey AS ref, max(l_linenumber) AS act,
        nullif(max(l_returnflag), 'N') AS argument, sum(CAST(l_quantity AS BIGINT)) AS seconds
    FROM lineitem GROUP BY l_orderkey, l_suppkey),
steps AS (
    SELECT id, ref, CASE act {_ACTION_CASES} END || ': ' || coalesce(argument, '') AS step_name,
        CASE WHEN seconds = 13 OR seconds < 2 THEN 0 ELSE seconds END AS step_seconds
    FROM step_rows WHERE act <> 3 AND id IN (SELECT o_orderkey FROM orders)),
timed AS (
    SELECT *, coalesce(sum(step_seconds) OVER (PARTITION BY id ORDER BY ref
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offset_seconds
    FROM steps)"""

EVENTS = f"""{LOG}, {BATCHES}, {SPANS}, {STEPS},
placed AS (
    SELECT t.*, batch_finish, coalesce(least(batch_start + to_seconds(CAST(offset_seconds AS BIGINT)),
        batch_finish - INTERVAL 1 SECOND)) AS start_time
    FROM timed AS t JOIN spans AS s ON t.id = s.batch),
events AS (
    SELECT b."Id" AS batch_id, CAST(NULL AS INTEGER) AS step_ref, CAST(b."Id" AS DOUBLE) AS event_id,
        "Name" AS event_name, batch_start AS event_start, batch_finish AS event_finish
    FROM batches AS b JOIN spans AS s ON b."Id" = s.batch
        JOIN log AS l ON l.batch = b."Id" AND l.no = {START_CODE}
    UNION ALL
    SELECT id, CAST(ref AS INTEGER), id + ref / 100.0e0, coalesce(step_name, 'Unknown'), start_time,
        CASE WHEN batch_finish IS NOT NULL
            THEN least(start_time + to_seconds(CAST(step_seconds AS BIGINT)), batch_finish) END
    FROM placed)"""

_TIME = "'%Y-%m-%d %H:%M:%S'"

ORACLE["batch_started"] = f"""WITH {LOG}, {BATCHES}
SELECT "Id", "Name" FROM batches WHERE "Id" IN (SELECT batch FROM log WHERE no = {START_CODE})"""

ORACLE["batch_start_rows"] = f"""WITH {LOG}, {BATCHES}
SELECT b."Id", "Name", strftime(ts, {_TIME}) AS start_time
FROM batches AS b JOIN log ON b."Id" = batch AND no = {START_CODE}"""

ORACLE["batch_is_macro"] = f"""WITH {BATCHES}
SELECT "Id", "Name", "Id" IN (SELECT l_orderkey FROM lineitem) AS is_macro FROM batches"""

ORACLE["batch_spans"] = f"""WITH {LOG}, {SPANS}
SELECT batch AS "Id", strftime(batch_start, {_TIME}) AS batch_start,
    strftime(batch_finish, {_TIME}) AS batch_finish, n_starts FROM spans"""

ORACLE["step_offsets"] = f"""WITH {STEPS}
SELECT id AS "Id", ref AS "Reference", step_name, CAST(step_seconds AS BIGINT) AS step_seconds,
    CAST(offset_seconds AS BIGINT) AS offset_seconds FROM timed"""

ORACLE["batch_events"] = f"""WITH {EVENTS}
SELECT batch_id, step_ref, round(event_id, 4) AS event_id, event_name,
    strftime(event_start, {_TIME}) AS event_start, strftime(event_finish, {_TIME}) AS event_finish,
    CAST(date_diff('second', event_start, event_finish) AS DOUBLE) AS duration_in_seconds
FROM events"""

ORACLE["trace_rows"] = f"""WITH {EVENTS}
SELECT 0 AS pid, 0 AS tid, 'X' AS ph, event_name AS name,
    date_diff('microsecond', (SELECT min(event_start) FROM events), event_start) AS ts,
    CASE WHEN event_start = event_finish THEN 1
        ELSE date_diff('microsecond', event_start, event_finish) END AS dur
FROM events"""

ORACLE["trace_written"] = ORACLE["trace_rows"]

# --- reserves ----------------------------------------------------------------

# Amounts in units of 0.0001.
_UNITS = {
    "base": "price",
    "gid": "price * discount",
    "fees": "price * tax + quantity * discount + quantity * tax",
    "coi_load": "quantity + CASE WHEN l_linenumber <> 7 THEN discount END",
    "aalr": "CASE WHEN l_returnflag <> 'N' THEN price * tax END",
    "oyt": "price * discount",
    "gross": "retail",
    "def": "tax",
    "tax_gross": "retail * discount",
}
_UNIT_SQL = ", ".join(
    f"CAST(10000 * CAST({sql} AS DECIMAL(14,4)) AS DECIMAL(18,0)) AS {name}"
    for name, sql in _UNITS.items()
)

POLICIES = f"""policies AS (
    SELECT l_orderkey, l_linenumber,
        {_text_list(PLAN_CODES)}[p_size % {len(PLAN_CODES)} + 1] AS plan_code,
        {_text_list(MOSES_CODES)}[l_linenumber % {len(MOSES_CODES)} + 1] AS moses,
        CASE WHEN o_orderpriority <> '5-LOW' THEN 'P' END AS med_flag,
        CASE WHEN l_linestatus = 'F' THEN '0' ELSE '_' END AS era,
        l_suppkey % 5 + 1 AS company, year(o_orderdate) AS issue_year,
        CASE l_returnflag WHEN 'A' THEN 'eti' WHEN 'R' THEN 'rpu' ELSE 'regular' END AS lapse_status,
        CAST(l_extendedprice AS DECIMAL(14,2)) AS price,
        CAST(l_quantity AS DECIMAL(14,2)) AS quantity,
        CAST(l_discount AS DECIMAL(4,2)) AS discount, CAST(l_tax AS DECIMAL(4,2)) AS tax,
        CAST(p_retailprice AS DECIMAL(12,2)) AS retail, l_returnflag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
measured AS (
    SELECT *,
        CASE WHEN company IN (2, 3) THEN 'TLIC' WHEN company IN (4, 5) THEN 'TFLIC'
            ELSE 'undefined' END AS legal_entity,
        {_UNIT_SQL}
    FROM policies),
charged AS (
    SELECT *, plan_code IN ('EIS', 'EIJ') AS esti,
        CASE WHEN plan_code IN ('EIS', 'EIJ') THEN fees ELSE fees + coi_load END AS accrued_charges,
        CASE WHEN plan_code IN ('EIS', 'EIJ') THEN -coi_load ELSE 0 END AS unearned_coi,
        CASE WHEN aalr > oyt THEN aalr ELSE oyt END AS stat_gmdb,
        CASE WHEN aalr > oyt THEN aalr ELSE oyt END * CAST(0.9281 AS DECIMAL(4,4)) AS tax_gmdb
    FROM measured),
reserved AS (
    SELECT *, base - accrued_charges AS sa,
        gross + gid + unearned_coi - accrued_charges AS stat_liability,
        tax_gross + gid + unearned_coi - accrued_charges AS tax_liability,
        gross - base - stat_gmdb - def + unearned_coi + gid AS stat_ga,
        tax_gross - base + unearned_coi + gid - tax_gmdb AS tax_ga,
        CASE WHEN moses = 'PRM5' AND med_flag = 'P' THEN 'CET80'
            WHEN moses = 'PRM6' AND med_flag = 'P' AND era = '0' THEN 'CET80'
            WHEN moses IN ('PRM3', 'PRM4') AND plan_code <> 'SCHD' THEN
                CASE WHEN lapse_status = 'eti' THEN 'CET58' ELSE 'CSO58' END
            ELSE 'CSO80' END AS mortality_basis
    FROM charged)"""

# Plan codes and the names they lead to.
CODES = """first_codes AS (
    SELECT *, CASE
        WHEN plan_code IN ('7PY', 'L83', 'L84', 'V81', 'V83', 'V84', 'LPE', 'VPE') THEN
            CASE lapse_status WHEN 'regular' THEN '58 CSO 4.5% MOD CRVM CNF (81-88)'
                WHEN 'eti' THEN '58 CET 4.5% CNF (81-88)' WHEN 'rpu' THEN '58 CSO 4.5% CNF (81-88)' END
        WHEN plan_code IN ('P83', 'PP3', 'PP4', 'S81', 'S83') THEN '58 CSO 4.5% CNF (81-88)'
        WHEN plan_code = 'SP1' THEN CASE WHEN lapse_status = 'eti' THEN '80 CET 4% NLP CNF (86-89)'
            ELSE '80 CSO 4% MOD CRVM CNF (88-91)' END
        WHEN plan_code IN ('P1J', 'P1S', 'P2J', 'P2S', 'MSA', 'P6S', 'P6J', 'P7S', 'P7J', 'P8S',
            'P8J', 'A1S') THEN CASE mortality_basis WHEN 'CSO80' THEN '80 CSO 4% CNF (86-03)'
            WHEN 'CET80' THEN '80 CET 4% NLP CNF (86-89)' END
        WHEN plan_code IN ('EIS', 'EIJ') THEN CASE WHEN issue_year < 1995 THEN '80 CSO 5% CNF (93-94)'
            ELSE '80 CSO 4.5% CNF (95-01)' END
        END AS tlic_code
    FROM reserved),
coded AS (
    SELECT *, CASE WHEN company IN (2, 3) THEN tlic_code WHEN company IN (4, 5) THEN
        CASE tlic_code
            WHEN '58 CET 4.5% CNF (81-88)' THEN '58 CET 4.5% ANB NL CNF (81-88)'
            WHEN '58 CSO 4.5% CNF (81-88)' THEN '58 CSO 4.5% ANB NL CNF (81-88)'
            WHEN '58 CSO 4.5% MOD CRVM CNF (81-88)' THEN '58 CSO 4.5% ANB MOD CRVM CNF (81-88)'
            WHEN '80 CET 4% NLP CNF (86-89)' THEN '80 CET 4% ANB NL CNF (86-89)'
            WHEN '80 CSO 4% CNF (86-03)' THEN '80 CSO 4% ANB NL CNF (86-01)'
            WHEN '80 CSO 4% MOD CRVM CNF (88-91)' THEN '80 CSO 4% ANB MOD CRVM CNF (88-91)'
        END END AS stat_code
    FROM first_codes)"""

# Published field -> expression over the row; 0 where nothing is booked.
# Published fields.
FIELDS = {
    "JE_2001D1R": "stat_ga",
    "JE_2001C1R": "0",
    "JE_200DD1R": "stat_gmdb",
    "JE_200AD1R": "def",
    "JE_2008D1R": "0",
    "JE_150211R": "0",
    "JE_151211R": "0",
    "JE_2061D1R": "0",
    "ex5_A_direct": "stat_ga",
    "ex5_A_ceded": "0",
    "ex5_G_gmdb": "stat_gmdb",
    "ex5_G_def": "def",
    "ex5_G_ceded": "0",
    "ex5_E_alr": "0",
    "ex5_F_dlr": "0",
    "Tax_2001D1R": "tax_ga",
    "Tax_2001C1R": "0",
    "Tax_200DD1R": "tax_gmdb",
    "Tax_200AD1R": "0",
    "Tax_2008D1R": "0",
    "Tax_150211R": "0",
    "Tax_151211R": "0",
    "Tax_2061D1R": "0",
    "KC4_total_stat": "stat_liability",
    "KC4_total_tax": "tax_liability",
    "KC4_stat_sa": "sa",
    "KC4_tax_sa": "sa",
    "KC4_stat_ga": "stat_ga",
    "KC4_tax_ga": "tax_ga",
    "KC4_stat_gmdb_reserve": "stat_gmdb",
    "KC4_tax_gmdb_reserve": "tax_gmdb",
    "KC4_stat_def_reserve": "def",
    "KC4_tax_def_reserve": "0",
    "KC4_stat_ceded_reserve": "0",
    "KC4_tax_ceded_reserve": "0",
}


def _field_list(wrap: str, digits: int) -> str:
    """The fields as doubles; those that hold a multiple of the tax factor are rounded."""
    amounts = {name: f"CAST({wrap.format(sql)} AS DOUBLE)" for name, sql in FIELDS.items()}
    return ", ".join(
        f"round({sql}, {digits}) AS {name}" if FIELDS[name] in ("tax_ga", "tax_gmdb") else f"{sql} AS {name}"
        for name, sql in amounts.items()
    )


ORACLE["stat_code_map"] = f"""WITH {POLICIES}, {CODES}
SELECT l_orderkey, l_linenumber, mortality_basis, stat_code FROM coded"""

ORACLE["stat_code_function"] = f"""WITH {POLICIES}, {CODES}
SELECT stat_code, count(*) AS n_policies FROM coded GROUP BY stat_code"""

_BASIS_VALUES = ", ".join(str(row) for row in MORTALITY_BASIS_ROWS)
ORACLE["mortality_map_join"] = f"""WITH {POLICIES}
SELECT l_orderkey, l_linenumber, p.plan_code, p.moses AS moses_plan_code, p.med_flag, p.era,
    p.lapse_status, b.mortality_basis
FROM policies AS p LEFT JOIN (VALUES {_BASIS_VALUES})
    AS b(plan_code, moses, med_flag, era, lapse_status, mortality_basis)
  ON p.plan_code = b.plan_code AND p.moses = b.moses AND p.med_flag = b.med_flag
    AND p.era = b.era AND p.lapse_status = b.lapse_status"""

ORACLE["extended_reserves"] = f"""WITH {POLICIES}, {CODES}
SELECT l_orderkey, l_linenumber, lapse_status, legal_entity, '101M0000' AS "JE_center",
    '101M0000' AS "Tax_center", stat_code AS ex5_stat_code,
    CAST(accrued_charges AS DOUBLE) AS accrued_charges, CAST(unearned_coi AS DOUBLE) AS unearned_coi,
    CAST(CASE WHEN lapse_status = 'eti' THEN gross ELSE 0 END AS DOUBLE) AS stat_eti_reserve,
    0.0e0 AS tax_eti_reserve,
    CAST(CASE WHEN lapse_status = 'rpu' THEN gross ELSE 0 END AS DOUBLE) AS stat_rpu_reserve,
    0.0e0 AS tax_rpu_reserve, {_field_list("{}", 4)}
FROM coded"""

ORACLE["reserve_summary"] = f"""WITH {POLICIES}
SELECT legal_entity, {_field_list("sum({})", -3)} FROM reserved
GROUP BY legal_entity ORDER BY legal_entity DESC"""

# Doubles row by row, in the order of the job's operations; their sums are whole numbers of
# 2^-70, of which all amounts here are multiples, and are rounded once.
def _exact_sum(sql: str) -> str:
    if sql == "0":
        return "0.0::DOUBLE"
    whole = f"sum(CAST({sql} * 1180591620717411303424.0::DOUBLE AS HUGEINT))"
    return f"CAST(CAST({whole} AS VARCHAR) AS DOUBLE) / 1180591620717411303424.0::DOUBLE"


ORACLE["reserve_sums_exact"] = f"""WITH policies AS (
    SELECT {_text_list(PLAN_CODES)}[p_size % {len(PLAN_CODES)} + 1] IN ('EIS', 'EIJ') AS esti,
        CASE WHEN l_suppkey % 5 + 1 IN (2, 3) THEN 'TLIC' WHEN l_suppkey % 5 + 1 IN (4, 5) THEN 'TFLIC'
            ELSE 'undefined' END AS legal_entity,
        l_extendedprice AS base, l_extendedprice * l_discount AS gid,
        l_extendedprice * l_tax + l_quantity * l_discount + l_quantity * l_tax AS fees,
        l_quantity + CASE WHEN l_linenumber <> 7 THEN l_discount END AS coi_load,
        CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * l_tax END AS aalr,
        l_extendedprice * l_discount AS oyt,
        p_retailprice AS gross, l_tax AS def, p_retailprice * l_discount AS tax_gross
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
charged AS (
    SELECT *, CASE WHEN esti THEN fees ELSE fees + coi_load END AS accrued,
        gid + CASE WHEN esti THEN -coi_load ELSE 0.0::DOUBLE END AS own,
        CASE WHEN aalr > oyt THEN aalr ELSE oyt END AS stat_gmdb,
        CASE WHEN aalr > oyt THEN aalr ELSE oyt END * 0.9281::DOUBLE AS tax_gmdb
    FROM policies),
reserved AS (
    SELECT *, base - accrued AS sa, gross + own - accrued AS stat_liability,
        tax_gross + own - accrued AS tax_liability,
        gross + own - (base + stat_gmdb + def) AS stat_ga,
        tax_gross + own - (base + tax_gmdb) AS tax_ga
    FROM charged)
SELECT legal_entity, {", ".join(f"{_exact_sum(sql)} AS {name}" for name, sql in FIELDS.items())}
FROM reserved GROUP BY legal_entity"""

# --- scenario pack and tables ------------------------------------------------

PACK = f"""{ALL_CASH_FLOWS}, {SCENARIOS},
pack_flows AS (SELECT scenario_no, t, t - 60 AS step, benefits AS death FROM all_cash_flows),
pack_discounts AS (SELECT * FROM scenarios)"""

ORACLE["pack_join"] = f"""WITH {PACK}
SELECT f.scenario_no AS "ScnNumber", f.t AS "RowNo", step AS "Step",
    d.scenario_no AS "discount_ScnNumber", d.t AS "ProjMonth",
    round(CAST(death AS DOUBLE), 8) AS death,
    round(CAST(discount_factor AS DOUBLE), 8) AS "Discount_Factor"
FROM pack_flows AS f JOIN pack_discounts AS d ON f.scenario_no = d.scenario_no AND f.t = d.t"""

ORACLE["pack_filtered_sum"] = f"""WITH {PACK}
SELECT round(CAST(sum(death) AS DOUBLE), 4) AS total_death FROM pack_flows WHERE step > 0"""

ORACLE["pack_count"] = f"WITH {PACK} SELECT count(*) AS cnt FROM pack_discounts"

ORACLE["table_scan"] = """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7"""

ORACLE["query_text"] = """
SELECT o_orderpriority, count(*) AS n_orders FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 1000 GROUP BY o_orderpriority"""

ORACLE["top10"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"""

# --- files -------------------------------------------------------------------

ORACLE["csv_roundtrip"] = "SELECT * FROM orders"

ORACLE["csv_text_roundtrip"] = "SELECT conv_id, turn, role, text FROM conversations"

ORACLE["csv_whitespace"] = r"""
SELECT doc_id, text, '  ' || text || ' ' || chr(10) AS padded, '"\' || text || '\"' AS in_quotes,
    '' AS empty, CAST(NULL AS VARCHAR) AS missing
FROM documents"""

ORACLE["csv_ranges_roundtrip"] = "SELECT * FROM documents"

ORACLE["bulk_load"] = "SELECT * FROM customer"

ORACLE["bulk_load_once"] = "SELECT * FROM customer"

ORACLE["bulk_load_texts"] = """
SELECT conv_id, turn, role, text FROM conversations
UNION ALL SELECT conv_id, turn, role, text FROM conversations"""

ORACLE["dbf_limit"] = "SELECT least(count(*), 100) AS n_records FROM orders"

ORACLE["reports_written"] = ORACLE["slice_dice_1"]

_DBF_ORDERS = """
SELECT o_orderkey AS "ID", CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS "CUST",
    o_totalprice AS "PRICE", {priority} AS "PRIORITY", o_orderstatus = 'F' AS "DONE",
    strftime(o_orderdate, '%Y-%m-%d') AS "ORDERED"
FROM orders"""

ORACLE["dbf_roundtrip"] = _DBF_ORDERS.format(priority="o_orderpriority")

ORACLE["dbf_custom_widths"] = _DBF_ORDERS.format(priority="trim(substr(o_orderpriority, 1, 6))")

ORACLE["dbf_permissive"] = """
WITH rows AS (
    SELECT o_orderkey AS "ID", CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 1)
        ELSE o_orderpriority END AS level
    FROM orders)
SELECT "ID", TRY_CAST(level AS BIGINT) AS "LEVEL" FROM rows WHERE level <> '5'"""

ORACLE["dbf_catalog"] = """
SELECT 'nation' AS table_name, f.field_no, f.field_name, f.field_type,
    CAST(CASE f.field_no WHEN 2 THEN w.width ELSE 18 END AS INTEGER) AS field_length,
    0 AS field_decimals, w.n AS record_count
FROM (SELECT max(length(n_name)) AS width, count(*) AS n FROM nation) AS w,
    (VALUES (1, 'ID', 'N'), (2, 'NAME', 'C'), (3, 'REGION', 'N')) AS f(field_no, field_name, field_type)
UNION ALL
SELECT 'customer', f.field_no, f.field_name, f.field_type,
    CAST(coalesce(f.field_length, w.width) AS INTEGER), f.field_decimals, w.n
FROM (SELECT max(length(c_name)) AS width, count(*) AS n FROM customer) AS w,
    (VALUES (1, 'ID', 'N', 18, 0), (2, 'NAME', 'C', NULL, 0), (3, 'BALANCE', 'F', 20, 6))
        AS f(field_no, field_name, field_type, field_length, field_decimals)"""

ORACLE["max_width"] = """
SELECT CAST(max(length(text)) AS INTEGER) AS text, CAST(max(length(lang)) AS INTEGER) AS lang,
    CAST(max(length(source)) AS INTEGER) AS source FROM documents"""

# --- texts -------------------------------------------------------------------

ORACLE["latest_lien"] = """
SELECT o_orderkey AS policy_id, CASE o_orderstatus WHEN 'F' THEN 7081.0e0 WHEN 'P' THEN 0.0e0
    ELSE o_totalprice END AS lien_amount FROM orders"""

ORACLE["latest_lien_lines"] = """
SELECT o_custkey AS policy_id, coalesce(arg_max(
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0e0 END, o_orderkey)
    FILTER (WHERE o_orderstatus <> 'O'), 0.0e0) AS lien_amount
FROM orders GROUP BY o_custkey"""

ORACLE["text_lines"] = r"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS line
FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS lines FROM documents) AS d,
    LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)"""

MODULES = """old_modules AS (
    SELECT 'Module' || CAST(doc_id AS VARCHAR) AS name, text FROM documents
    WHERE NOT starts_with(source, 'src1')),
new_modules AS (
    SELECT 'Module' || CAST(doc_id AS VARCHAR) AS name,
        CASE WHEN lang = 'en' THEN text || chr(10) || 'End Sub' ELSE text END AS text
    FROM documents),
compared AS (
    SELECT n.name, md5(n.text) AS digest, md5(o.text) AS old_digest, n.text AS new_text
    FROM new_modules AS n LEFT JOIN old_modules AS o ON n.name = o.name
    WHERE length(n.text) > 0 AND NOT regexp_matches(n.name, '(?i)^MODULE.*7$'))"""

ORACLE["snapshot_diff"] = f"""WITH {MODULES}
SELECT name, CASE WHEN old_digest IS NULL THEN 'New' WHEN old_digest = digest THEN 'Unchanged'
    ELSE 'Conflict' END AS status, digest, old_digest FROM compared"""

ORACLE["snapshot_merge"] = f"""WITH {MODULES}
SELECT name, digest FROM compared
UNION ALL
SELECT name, md5(text) FROM old_modules WHERE name NOT IN (SELECT name FROM compared)"""

ORACLE["lcs_match"] = """
WITH RECURSIVE steps AS (
    SELECT p_partkey, p_name AS a, lower(p_type) AS b, 0 AS i,
        list_transform(range(0, length(p_type)), lambda x: 0) AS best
    FROM part
    UNION ALL
    SELECT p_partkey, a, b, i + 1, list_transform(range(1, length(b) + 1), lambda j:
        list_max(list_transform(range(1, j + 1), lambda k:
            CASE WHEN b[k] = a[i + 1] THEN 1 + CASE WHEN k > 1 THEN best[k - 1] ELSE 0 END
                ELSE best[k] END)))
    FROM steps WHERE i < length(a))
SELECT p_partkey, best[length(b)] AS lcs_length FROM steps WHERE i = length(a)"""

_LENGTHS = """list_transform(range(1, length(b) + 1), lambda j:
        list_max(list_transform(range(1, j + 1), lambda k:
            CASE WHEN b[k] = a[i + 1] THEN 1 + CASE WHEN k > 1 THEN best[k - 1] ELSE 0 END
                ELSE best[k] END)))"""

ORACLE["lcs_best"] = f"""
WITH RECURSIVE pairs AS (
    SELECT c_custkey, s_suppkey, c_name AS a, s_name AS b
    FROM customer JOIN supplier ON c_nationkey = s_nationkey),
steps AS (
    SELECT c_custkey, s_suppkey, a, b, 0 AS i,
        list_transform(range(0, length(b)), lambda x: 0) AS best
    FROM pairs
    UNION ALL
    SELECT c_custkey, s_suppkey, a, b, i + 1, {_LENGTHS}
    FROM steps WHERE i < length(a)),
ranked AS (
    SELECT c_custkey, s_suppkey, best[length(b)]::BIGINT AS best_length,
        row_number() OVER (PARTITION BY c_custkey ORDER BY best[length(b)] DESC, s_suppkey) AS place
    FROM steps WHERE i = length(a))
SELECT c.c_custkey, r.s_suppkey AS best_key, r.best_length
FROM customer AS c LEFT JOIN ranked AS r ON r.c_custkey = c.c_custkey AND r.place = 1"""

# Rows of the table hold the common text itself; the end of the left text is dropped first.
ORACLE["lcs_common_text"] = """
WITH RECURSIVE steps AS (
    SELECT p_partkey, p_name AS a, lower(p_type) AS b, 0 AS i,
        list_transform(range(0, length(p_type) + 1), lambda x: '') AS best
    FROM part
    UNION ALL
    SELECT p_partkey, a, b, i + 1, list_reduce(list_prepend([''], list_transform(
            range(1, length(b) + 1), lambda j: [b[j], best[j], best[j + 1]])),
        lambda row, x: list_append(row, CASE WHEN x[1] = a[i + 1] THEN x[2] || x[1]
            WHEN length(row[-1]) > length(x[3]) THEN row[-1] ELSE x[3] END))
    FROM steps WHERE i < length(a))
SELECT p_partkey, best[-1] AS lcs FROM steps WHERE i = length(a)"""

ORACLE["pattern_join"] = """
WITH numbered AS (
    SELECT s_suppkey, lpad((s_suppkey % 1000)::VARCHAR, 3, '0') AS n FROM supplier),
patterns AS (
    SELECT s_suppkey, 0 AS form, '.*' || n || '.*' AS pattern FROM numbered
    UNION ALL SELECT s_suppkey, 1, '[CD]ustomer#0+' || n || '.?$' FROM numbered
    UNION ALL SELECT s_suppkey, 2, '.*' || n || '1$|.*7' || n || '|Supplier.*' || n FROM numbered)
SELECT c_custkey, c_name, s_suppkey, form, pattern
FROM customer JOIN patterns ON regexp_matches(c_name, '^(?:' || pattern || ')')"""
