"""Oracle SQL of single operators, sources and validation runs."""

from __future__ import annotations

from hirelattice.plans import recruiting

from . import hiring_sql, sql, star_sql

_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS \"rows\" FROM {name}"
    for name in ["clients", "vacancies", "candidates", "applications", "placements", "marketing_daily", "sales_deals"]
)


def _all_found(child: str, key: str, parent: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {child} WHERE {key} IS NULL OR {key} NOT IN (SELECT {key} FROM {parent}))"


_CONDITIONS = {
    "vacancies have clients": _all_found("vacancies", "client_id", "clients"),
    "applications have vacancies": _all_found("applications", "vacancy_id", "vacancies"),
    "applications have candidates": _all_found("applications", "candidate_id", "candidates"),
    "placements have vacancies": _all_found("placements", "vacancy_id", "vacancies"),
    "placements have candidates": _all_found("placements", "candidate_id", "candidates"),
    "closed on or after opening": "NOT EXISTS (SELECT 1 FROM vacancies WHERE closed_at < opened_at)",
    "open means not closed": "NOT EXISTS (SELECT 1 FROM vacancies WHERE status = 'open' AND closed_at IS NOT NULL)",
    "every vacancy is filled": "NOT EXISTS (SELECT 1 FROM vacancies WHERE status IS DISTINCT FROM 'filled')",
}


def queries(project: str) -> dict[str, str]:
    faulty = hiring_sql.FAULT_AUDIT
    one_run = (
        f"SELECT 'validation' AS run_type, status, total AS checks_total, failed AS checks_failed, "
        f"CAST(NULL AS VARCHAR) AS error_message FROM ({sql.summary(faulty)})"
    )
    message = "left(repeat('audit stopped after ' || (SELECT count(*) FROM orders) || ' orders; ', 40), 500)"
    gate = "\nUNION ALL ".join(
        f"SELECT '{case}' AS \"case\", bad = 0 AS passed, CASE WHEN bad = 0 THEN 7 ELSE 0 END::BIGINT AS tables_written "
        f"FROM (SELECT count(*) FILTER (status <> 'PASS') AS bad FROM ({audit}))"
        for case, audit in (("clean", hiring_sql.GATE), ("faulty", hiring_sql.FAULT_GATE))
    )
    return {
        "first_seen_users": "SELECT user_id, CAST(min(ts) AS DATE) AS first_day FROM events GROUP BY 1",
        "rarest_customer": """
SELECT o_custkey, count(*) AS "rows" FROM orders WHERE o_custkey IS NOT NULL
GROUP BY 1 ORDER BY 2, 1 LIMIT 1""",
        "scalar_functions": f"""
SELECT o_orderkey, {sql.month('o_orderdate')} AS order_month, CAST(o_orderdate AS DATE) AS order_day,
  CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS age_days,
  CAST(least(greatest(CAST(o_orderdate AS DATE) - DATE '1995-01-01', 100), 2000) AS INTEGER) AS age_clipped,
  CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS due_day,
  greatest(CAST(o_orderdate AS DATE), DATE '1997-01-01') AS later_day,
  CASE WHEN isodow(o_orderdate) <= 5 THEN 'weekday' ELSE 'weekend' END AS day_kind,
  printf('ord_%06d', o_orderkey + 1) AS order_id, o_orderkey + 1 AS order_number,
  CAST(o_orderkey AS DOUBLE) / NULLIF(CAST(o_custkey AS DOUBLE), 0) AS key_ratio,
  abs(o_custkey - 500) AS distance, substring(o_orderpriority, 1, 4) AS priority_start,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time, {sql.number_text('o_totalprice')} AS price_text
FROM orders""",
        "orphan_documents": """
SELECT doc_id, lang, source, n_chars FROM documents AS d
WHERE NOT EXISTS (SELECT 1 FROM labels AS l WHERE l.doc_id = d.doc_id)""",
        "labelled_documents": """
SELECT doc_id, lang, source, n_chars FROM documents AS d
WHERE EXISTS (SELECT 1 FROM labels AS l WHERE l.doc_id = d.doc_id)""",
        "customers_without_orders": """
SELECT count(*) AS orphans FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
        "key_conditions": f"{hiring_sql.BASE}\n" + "\nUNION ALL ".join(
            f"SELECT '{name}' AS condition, {held} AS holds" for name, held in _CONDITIONS.items()
        ),
        "csv_load_report": f"{hiring_sql.BASE}\n{_COUNTS}",
        "csv_loaded_vacancies": f"{hiring_sql.BASE} SELECT * FROM vacancies",
        "csv_loaded_sales_deals": f"{hiring_sql.BASE} SELECT * FROM sales_deals",
        "csv_loaded_marketing_daily": f"{hiring_sql.BASE} SELECT * FROM marketing_daily",
        "csv_loaded_documents": "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, n_chars FROM documents",
        "csv_inferred_orders": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderday FROM orders""",
        "table_replaced": "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1",
        "table_replaced_by_month": f"""
SELECT {sql.month('o_orderdate')} AS order_month, count(*) AS orders, min(o_orderkey) AS first_order, max(o_orderkey) AS last_order
FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1""",
        "run_log_appended_once": f"SELECT run_id, status, checks_total, checks_failed, error_message FROM {star_sql.RUN_LOG}",
        "audit_from_counters": faulty,
        "monthly_revenue_kept": hiring_sql.REPORTS["monthly_revenue"],
        "recent_runs_by_day": star_sql.REPORTS["recent_runs"],
        "ids_on_growth": """
SELECT printf('ord_%06d', row_number() OVER (ORDER BY batch, o_orderkey)) AS order_id, o_orderkey, batch
FROM (SELECT o_orderkey, CASE WHEN year(o_orderdate) < 1994 THEN 'a' WHEN year(o_orderdate) = 1994 THEN 'b' ELSE 'c' END AS batch FROM orders)""",
        "csv_load_stamps": f"{hiring_sql.BASE}\n" + "\nUNION ALL ".join(
            f"SELECT '{name}' AS \"table\", least(count(*), 1) AS stamps, 0::BIGINT AS unstamped FROM {name}"
            for name in recruiting.TABLES
        ),
        "table_kept_when_replacing_fails": "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1",
        "audit_stamps": f"SELECT least(count(*), 1) AS stamps, 0::BIGINT AS unstamped FROM ({faulty})",
        "run_log_success": (
            "SELECT 'success' AS status, count(*) AS checks_total, 0::BIGINT AS checks_failed, "
            f"CAST(NULL AS VARCHAR) AS error_message FROM ({faulty}) WHERE status = 'PASS'"
        ),
        "run_error_log": f"SELECT 'error' AS status, 0::BIGINT AS checks_total, 1::BIGINT AS checks_failed, {message} AS error_message",
        "run_error_failures": (
            "SELECT 0::BIGINT AS total, 1::BIGINT AS failed, 0::BIGINT AS passed, 'error' AS check_type, "
            f"'pipeline_error' AS check_name, {message} AS description, CAST(NULL AS DOUBLE) AS expected, "
            "CAST(NULL AS DOUBLE) AS actual"
        ),
        "run_error_alert": (
            f"SELECT '⚠️ Data validation failed ({project})' || chr(10) || chr(10) || "
            "'1 of 0 checks failed (run status: error).' || chr(10) || chr(10) || "
            f"'• pipeline_error: ' || {message} AS message"
        ),
        "gate_writes": gate,
        "audit_readback": (
            f"SELECT check_type, check_name, description, expected, actual, status FROM ({faulty})"
        ),
        "run_log": f"SELECT * FROM ({one_run}) UNION ALL SELECT * FROM ({one_run})",
        "run_summary": sql.summary(faulty),
        "run_failures": (
            "SELECT check_type, check_name, description, expected, actual, status "
            f"FROM ({faulty}) WHERE status <> 'PASS'"
        ),
        "run_console_lines": sql.console(faulty),
        "run_alert": sql.alert(faulty, project),
        "alert_stream": sql.alert(faulty, project),
    }
