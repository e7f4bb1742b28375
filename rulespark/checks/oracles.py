"""The same queries as DuckDB SQL over the driver's tables."""

import re

from ..model import RULE_COLUMNS
from . import queries as q
from .fixtures import BASE_TABLE, VIEWS

_RULE_COLUMNS = ", ".join(RULE_COLUMNS)
_SELECTED = f"module = '{q.MODULE}' AND stage = '{q.STAGE}' AND rule_status IN ('Active', 'Passive')"
_IN_PACKAGE = f"{_SELECTED} AND package = '{q.PACKAGE}'"
_MAPPED = f"r.rule_id = f.rule_id AND f.feed_id = '{q.FEED}' AND f.rule_applicable_status = 'Yes'"
_NEWEST_FIRST = "PARTITION BY rule_id ORDER BY created_dt DESC NULLS FIRST, rule_run_id DESC"
_START, _END = f"TIMESTAMP '{q.START}'", f"TIMESTAMP '{q.START + q.TIMEOUT}'"
_CATEGORY = """CASE WHEN rule_execution_status = 'Success' THEN 'success' WHEN rule_status = 'Passive' THEN 'passive'
     WHEN rule_status = 'Active' AND rule_id IN (SELECT rule_id FROM yes_mapped) THEN 'waiting'
     WHEN rule_status = 'Active' THEN 'unmapped' ELSE 'none' END AS category"""
_POSITIONS = ", ".join(f"({place}, '{package}')" for place, package in enumerate(q.PACKAGES))

# Named parts, each using only those above it.
_PARTS = {name: text.format(**{BASE_TABLE[name]: BASE_TABLE[name]}) for name, text in VIEWS.items()}
_PARTS |= {
    "applicable": f"SELECT DISTINCT {_RULE_COLUMNS} FROM fx_rules WHERE rule_status IN ('Active', 'Passive')",
    "yes_mapped": "SELECT DISTINCT rule_id FROM fx_feed_map WHERE rule_applicable_status = 'Yes'",
    "for_feed": f"""SELECT {_RULE_COLUMNS} FROM fx_rules r WHERE {_SELECTED}
        AND EXISTS (SELECT 1 FROM fx_feed_map f WHERE {_MAPPED})
        UNION SELECT {_RULE_COLUMNS} FROM fx_rules r WHERE {_SELECTED}
        AND NOT EXISTS (SELECT 1 FROM fx_feed_map f WHERE f.rule_id = r.rule_id)""",
    "asked": f"SELECT * FROM (VALUES {_POSITIONS}) v(package_position, asked_package)",
    "per_package": f"""SELECT {_RULE_COLUMNS}, package_position
        FROM for_feed JOIN asked ON package = asked_package""",
    "runnable": """SELECT *, CONCAT(rule_id, '_', CAST(package_position AS STRING)) AS rule_run_id FROM per_package""",
    "latest": f"""SELECT rule_id, rule_run_id, created_dt, rule_execution_status, exception_applied, rule_status FROM (
        SELECT *, ROW_NUMBER() OVER ({_NEWEST_FIRST}) AS rn FROM fx_status) s WHERE rn = 1""",
    "given_latest": "SELECT * FROM latest WHERE rule_id IN (SELECT rule_id FROM applicable)",
    "categories": f"SELECT *, {_CATEGORY} FROM given_latest",
    "at_start": f"""SELECT *, {_CATEGORY} FROM (SELECT *, ROW_NUMBER() OVER ({_NEWEST_FIRST}) AS rn FROM fx_status
        WHERE created_dt IS NULL OR created_dt <= {_START}) s WHERE rn = 1""",
    "groups": "SELECT DISTINCT package, slg, rule_id FROM applicable",
    "verdicts": """SELECT package, slg, count(*) AS given, count(category) AS in_ledger,
        count(*) FILTER (WHERE category IN ('success', 'passive', 'unmapped')
          OR (category = 'waiting' AND exception_applied = 'Yes')) AS passing
        FROM groups LEFT JOIN categories USING (rule_id) GROUP BY package, slg""",
    "judged": "SELECT *, in_ledger = 0 OR passing = given AS passes FROM verdicts",
    "history": """SELECT rule_id, count(*) FILTER (WHERE rule_execution_status = 'Success') AS successes,
        count(*) FILTER (WHERE rule_execution_status <> 'Success'
          AND coalesce(exception_applied, '') <> 'Yes') AS pending
        FROM fx_status GROUP BY rule_id""",
    "approved": "SELECT DISTINCT rule_id FROM fx_approvals WHERE approval_status = 'Approved'",
}


def oracle(sql):
    """A query with the parts it needs in front."""
    def named_in(text):
        return {name for name in _PARTS if re.search(rf"\b{name}\b", text)}

    needed, found = set(), named_in(sql)
    while found - needed:
        needed |= found
        found = set().union(*(named_in(_PARTS[name]) for name in needed))
    parts = ", ".join(f"{name} AS ({_PARTS[name]})" for name in _PARTS if name in needed)
    return f"WITH {parts}\n{sql}" if parts else sql


def rule_sql(name):
    """A sample program's text for DuckDB."""
    if name == "stale_order":
        day = f"DATE '{q.AS_OF_DATE[:4]}-{q.AS_OF_DATE[4:6]}-{q.AS_OF_DATE[6:]}'"
        spark_date = "date_sub(to_date('${as_of_date}', 'yyyyMMdd'), 90)"
        return q.program(name).replace(spark_date, f"{day} - INTERVAL 90 DAY")
    return _PYTHON_RULES_AS_SQL.get(name) or q.program(name)


_PYTHON_RULES_AS_SQL = {
    "big_discount": """
SELECT 'line|discount' AS HEADER_DATA, CAST(l_orderkey AS STRING) AS COL1, CAST(l_linenumber AS STRING) AS COL2,
       CAST(CAST(l_discount AS DECIMAL(18,2)) AS STRING) AS COL3
FROM lineitem WHERE l_discount > 0.095 AND l_quantity >= 45""",
    "user_gap": """
SELECT 'user|gap' AS HEADER_DATA, CAST(user_id AS STRING) AS COL1, CAST(event_id AS STRING) AS COL2, '' AS COL3
FROM (SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) e
WHERE ts > prev + INTERVAL 1 DAY""",
}

_ALL_RULES = q.SQL_RULES + q.PYTHON_RULES


def _saved(name):
    return (f"SELECT 'run_{name}' AS RULE_RUN_ID, '{name}' AS RULE_ID, HEADER_DATA, COL1, COL2, COL3 "
            f"FROM ({rule_sql(name)}) r_{name}")


def _ledger_select(source, status, workflow, minutes=0):
    return f"""SELECT rule_run_id, rule_id, rule_name, rule_type, rule_status, module, stage, package, slg,
       program_type, program_code, {status} AS rule_execution_status, '2024-03-01' AS execution_date,
       '2024-03-01' AS processing_date, 'No' AS exception_applied, '' AS action, {workflow} AS workflow_status,
       '2024-03-01 12:{30 + minutes}:00' AS created_dt FROM {source}"""


_SUPPORTED = "lower(program_type) IN ('sql', 'python')"
_FINAL = (f"CASE WHEN {_SUPPORTED} THEN 'Success' ELSE 'Failure' END",
          f"CASE WHEN {_SUPPORTED} THEN 'Completed' ELSE 'Failed' END")
_CUSTOMER = "SELECT CAST(c_custkey AS {key}) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _bound_query():
    sql = q.BOUND_QUERY
    for name, value in q.BOUND_VALUES.items():
        sql = sql.replace(f":{name}", f"'{value}'" if isinstance(value, str) else str(value))
    return sql


def _texts():
    total = " + ".join(f"(SELECT count(*) FROM ({rule_sql(name)}) t_{name})" for name in _ALL_RULES)
    debts = f"(SELECT count(*) FROM ({rule_sql('neg_balance')}) t)"
    texts = {
        "a1_parquet": "SELECT * FROM orders",
        "a3_csv": _CUSTOMER.format(key="INTEGER"),
        "a4_orc": "SELECT * FROM orders",
        "a4_json": _CUSTOMER.format(key="BIGINT"),
        "a6_load": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in q.TABLES),
        "a7_cast": """SELECT CAST(custkey AS INTEGER) AS custkey, nationkey, CAST(acctbal AS DOUBLE) AS acctbal,
            CAST("asof" AS DATE) AS "asof", segment FROM fx_raw_csv""",
        "a7_cast_bad_values": """SELECT custkey, TRY_CAST(nationkey AS INTEGER) AS nationkey,
            TRY_CAST(acctbal AS DOUBLE) AS acctbal, "asof", segment FROM fx_raw_csv""",
        "a7_count_bad_values": " UNION ALL ".join(
            f"""SELECT '{name}' AS "column", count(*) FILTER (WHERE {name} IS NOT NULL
            AND TRY_CAST({name} AS INTEGER) IS NULL) AS bad_values FROM fx_raw_csv"""
            for name in ("custkey", "nationkey", "segment")),
        "a7_set_aside": """SELECT custkey, nationkey, CASE WHEN nationkey IS NOT NULL AND TRY_CAST(nationkey AS INTEGER) IS NULL
            THEN 'nationkey' ELSE '' END AS bad_columns FROM fx_raw_csv""",
        "a10_bound_query": _bound_query(),
        "b1_select_rules": f"SELECT DISTINCT {_RULE_COLUMNS} FROM fx_rules WHERE {_IN_PACKAGE}",
        "b2_mapped_rules": f"""SELECT DISTINCT r.* FROM fx_rules r JOIN fx_feed_map f ON {_MAPPED}
            WHERE {_IN_PACKAGE}""",
        "b3_unmapped_rules": f"""SELECT DISTINCT r.* FROM fx_rules r WHERE {_IN_PACKAGE}
            AND NOT EXISTS (SELECT 1 FROM fx_feed_map f WHERE f.rule_id = r.rule_id)""",
        "b4_rules_for_feed": f"SELECT * FROM for_feed WHERE package = '{q.PACKAGE}'",
        "b4_rules_for_requests": f"""SELECT concat_ws('/', module, stage, package, feed) AS request_id, {_RULE_COLUMNS}
            FROM applicable r, (VALUES ('F0'), ('F1'), ('F2'), ('F3'), ('F4'), ('F5'), (NULL)) v(feed)
            WHERE feed IS NULL OR NOT EXISTS (SELECT 1 FROM fx_feed_map f WHERE f.rule_id = r.rule_id)
              OR EXISTS (SELECT 1 FROM fx_feed_map f WHERE f.rule_id = r.rule_id AND f.feed_id = feed
                AND f.rule_applicable_status = 'Yes')""",
        "b5_rules_for_packages": "SELECT * FROM per_package",
        "b7_rule_rows": """SELECT DISTINCT rule_id, rule_name, rule_type, rule_status, module, stage, package, slg,
            program_type, program_code, coalesce(CAST(created_dt AS STRING), '') AS created_dt,
            coalesce(created_by, '') AS created_by, coalesce(CAST(modified_dt AS STRING), '') AS modified_dt,
            coalesce(modified_by, '') AS modified_by FROM fx_rules""",
        "b8_has_feed_mapping": """SELECT rule_id, (SELECT count(*) FROM fx_feed_map f
            WHERE f.rule_id = r.rule_id AND f.rule_applicable_status = 'Yes') > 0 AS has_feed_mapping
            FROM (SELECT DISTINCT rule_id FROM fx_rules) r""",
        "b9_approved_rules": "SELECT rule_id FROM approved WHERE rule_id IN (SELECT rule_id FROM applicable)",
        "c3_as_of_date": """SELECT o_orderstatus, count(*) AS orders_before FROM orders
            WHERE CAST(o_orderdate AS DATE) < DATE '2001-07-01' GROUP BY o_orderstatus""",
        "c5_program_types": f"""SELECT CASE WHEN {_SUPPORTED} THEN lower(program_type) ELSE 'rejected' END AS handler,
            count(*) AS rules FROM fx_rules GROUP BY 1""",
        "c6_result_rows": _saved("neg_balance"),
        "c7_run_rule": f"""SELECT 'run_stale_order' AS rule_run_id, 'stale_order' AS rule_id, rule_execution_status,
            workflow_status, 'No' AS exception_applied, (SELECT count(*) FROM ({rule_sql('stale_order')}) t) AS result_rows
            FROM (VALUES ('Started', 'In Progress'), ('Success', 'Completed')) v(rule_execution_status, workflow_status)""",
        "c7_export": _saved("stale_order"),
        "c8_run_rules": " UNION ALL ".join(_saved(name) for name in _ALL_RULES),
        "d1_result_files": _saved("stale_order"),
        "d3_ledger_append": _ledger_select("runnable", "'Started'", "'In Progress'")
            + " UNION ALL " + _ledger_select("runnable", *_FINAL, minutes=5),
        "d3_appends_at_once": "SELECT * FROM fx_status",
        "d4_result_append": """SELECT CONCAT('run_', CAST(c_custkey AS STRING)) AS RULE_RUN_ID,
            c_mktsegment AS RULE_ID, 'customer|segment' AS HEADER_DATA, c_name AS COL1, '' AS COL2,
            CASE WHEN c_acctbal < 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) ELSE '' END AS COL3
            FROM customer""",
        "e1_started_rows": _ledger_select("runnable", "'Started'", "'In Progress'"),
        "e2_final_rows": _ledger_select("runnable", *_FINAL),
        "e4_latest_status": "SELECT * FROM given_latest",
        "e5_status_history": """SELECT rule_id, rule_run_id, rule_execution_status, exception_applied, created_dt
            FROM fx_status WHERE rule_id IN (SELECT rule_id FROM applicable)
            ORDER BY created_dt DESC NULLS FIRST, rule_run_id DESC, rule_id""",
        "e6_run_id": "SELECT count(*) AS rules, count(*) AS shaped, count(*) AS distinct_ids FROM runnable",
        "e8_latest_stream": "SELECT * FROM latest",
        "f1_empty_ledger": "SELECT package, slg, given, passes FROM judged WHERE in_ledger = 0",
        "f2_categories": "SELECT rule_id, category FROM categories",
        "f3_waiting_rules": "SELECT rule_id FROM categories WHERE category = 'waiting'",
        "f4_exception_check": """SELECT rule_id, coalesce(exception_applied = 'Yes', false) AS resolved
            FROM categories WHERE category = 'waiting'""",
        "f5_verdict": "SELECT * FROM judged",
        "f6_exceptions_in_time": f"""SELECT rule_id, coalesce(exception_applied = 'Yes', false) OR EXISTS (
            SELECT 1 FROM fx_status l WHERE l.rule_id = at_start.rule_id AND l.exception_applied = 'Yes'
            AND l.created_dt > {_START} AND l.created_dt <= {_END}) AS resolved
            FROM at_start WHERE category = 'waiting'""",
        "f6_wait": f"""SELECT a.rule_id, coalesce(a.exception_applied = 'Yes', false) OR coalesce(l.exception_applied = 'Yes', false)
            AS resolved FROM at_start a LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER ({_NEWEST_FIRST}) AS place FROM fx_status
            WHERE created_dt IS NULL OR created_dt <= {_END}) s WHERE place = 1) l USING (rule_id) WHERE category = 'waiting'""",
        "f7_all_succeeded_v1": """SELECT package, slg, count(*) AS given, coalesce(sum(successes), 0)::BIGINT AS successes,
            coalesce(sum(successes), 0) = count(*) AS passes
            FROM groups LEFT JOIN history USING (rule_id) GROUP BY package, slg""",
        "f8_exceptions_applied_v1": """SELECT package, slg, count(*) AS given, coalesce(sum(pending), 0)::BIGINT AS pending,
            coalesce(sum(pending), 0) = 0 AS passes
            FROM groups LEFT JOIN history USING (rule_id) GROUP BY package, slg""",
        "f9_verdict_v1": """SELECT *, approved = 0 OR successes = approved OR pending = 0 AS passes FROM (
            SELECT package, slg, count(a.rule_id) AS approved,
              coalesce(sum(successes) FILTER (WHERE a.rule_id IS NOT NULL), 0)::BIGINT AS successes,
              coalesce(sum(pending) FILTER (WHERE a.rule_id IS NOT NULL), 0)::BIGINT AS pending
            FROM groups g LEFT JOIN approved a USING (rule_id) LEFT JOIN history h USING (rule_id)
            GROUP BY package, slg) t""",
        "f9_verdict_of_run": f"""SELECT run, 8 AS rules, 8 AS succeeded, true AS passes, 0 AS exit_code, 2 * ({total}) AS result_rows
            FROM (VALUES (1), (2)) v(run)""",
        "f10_exit_code": "SELECT package, slg, CASE WHEN passes THEN 0 ELSE 100 END AS exit_code FROM judged",
        "f11_run": f"""SELECT 'ours' AS package, 8 AS rules, 8 AS succeeded, true AS passes, 0 AS exit_code,
            {total} AS result_rows, 0 AS failures
            UNION ALL SELECT 'theirs', 2, 1, false, 100, {debts}, 1
            UNION ALL SELECT 'leaving', 2, 1, false, 100, {debts}, 1
            UNION ALL SELECT 'nobody''s', 0, 0, true, 0, 0, 0""",
        "f11_resume": " UNION ALL ".join(f"""SELECT '{name}' AS rule_id, 8 AS rules, 8 AS succeeded, true AS passes, 1 AS final_rows,
            (SELECT count(*) FROM ({rule_sql(name)}) t_{name}) AS result_rows""" for name in _ALL_RULES),
        "h_stream_rule": f"SELECT 'neg_balance' AS RULE_ID, HEADER_DATA, COL1, COL2, COL3 FROM ({rule_sql('neg_balance')}) t",
        "g1_case": "SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand FROM part",
        "g2_replace": "SELECT doc_id, replace(text, 'a', '${b}') AS replaced FROM documents",
        "g5_dates": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS as_text,
            CAST(o_orderdate AS DATE) AS as_date, CAST(CAST(o_orderdate AS DATE) AS STRING) AS cast_text FROM orders""",
        "g7_arithmetic": """SELECT l_orderkey, l_orderkey + l_partkey AS added, l_orderkey - l_suppkey AS subtracted,
            l_partkey * l_suppkey AS multiplied,
            CASE WHEN l_partkey <= 807 THEN CAST(9223372036854775000 + l_partkey AS STRING) END AS added_or_null FROM lineitem""",
    }
    texts["f6_stream"] = texts["f6_timers"] = texts["f6_exceptions_in_time"]
    texts["f5_stream"] = texts["f5_verdict"]
    texts["a7_observed"] = texts["a7_count_bad_values"]
    texts["c8_shared"] = texts["c8_run_rules"]
    texts |= {f"c1_{name}": rule_sql(name) for name in q.SQL_RULES}
    texts |= {f"c4_{name}": rule_sql(name) for name in q.PYTHON_RULES}
    return texts


def all_oracles():
    return {name: oracle(text) for name, text in sorted(_texts().items())}
