"""Oracle SQL on the star tables."""

from __future__ import annotations

from hirelattice.plans import star

from . import sql

SHIPMENTS = "(SELECT l_shipdate, o_orderdate, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"

CHECKS = {
    "orphan_orders_customer": ("0", sql.orphans("orders", "o_custkey", "customer", "c_custkey")),
    "orphan_lines_order": ("0", sql.orphans("lineitem", "l_orderkey", "orders", "o_orderkey")),
    "orphan_documents_label": ("0", sql.orphans("documents", "doc_id", "labels", "doc_id")),
    "orphan_events_customer": ("0", sql.orphans("events", "user_id", "customer", "c_custkey")),
    "orphan_lines_part": ("0", sql.orphans("lineitem", "l_partkey", "part", "p_partkey")),
    "duplicate_order_key": ("0", sql.surplus("orders", "o_orderkey")),
    "duplicate_line_order_key": ("0", sql.surplus("lineitem", "l_orderkey")),
    "duplicate_document_text": ("0", sql.surplus("documents", "text")),
    "orders_vs_returned_lines": (sql.rows("lineitem", "l_returnflag = 'R'"), sql.rows("orders")),
    "customers_vs_purchases": (sql.rows("events", "event_type = 'purchase'"), sql.rows("customer")),
    "user_turns_without_answer": (
        "0",
        "(SELECT count(*) FROM conversations AS q WHERE q.role = 'user' AND NOT EXISTS (SELECT 1 FROM conversations "
        "AS r WHERE r.role = 'assistant' AND r.conv_id = q.conv_id AND r.turn = q.turn + 1))",
    ),
    "orders_without_rated_customer": (
        "0",
        "(SELECT count(*) FROM orders LEFT JOIN (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS rating "
        "FROM customer) ON o_custkey = c_custkey WHERE rating IS NULL)",
    ),
    "order_value_vs_monthly_report": (
        sql.summed("orders", "o_totalprice"), sql.by_month("orders", "o_totalprice", "o_orderdate"),
    ),
    "order_value_vs_solvent_customers": (
        sql.summed("orders", "o_totalprice"),
        sql.summed("orders JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0", "o_totalprice"),
    ),
    "finished_orders_without_customer": ("0", sql.rows("orders", "o_orderstatus = 'F' AND o_custkey IS NULL")),
    "error_events_with_value": ("0", sql.rows("events", "event_type = 'error' AND value IS NOT NULL")),
    "shipped_before_ordered": ("0", sql.rows(SHIPMENTS, "l_shipdate < o_orderdate")),
    "negative_or_missing_balance": ("0", sql.rows("customer", "c_acctbal IS NULL OR c_acctbal < 0")),
    "discount_exceeds_quantity": ("0", sql.rows("lineitem", "l_discount > l_quantity")),
    "purchases_without_user": ("0", sql.rows("events", "event_type = 'purchase' AND user_id IS NULL")),
    "page_events_without_value": ("0", sql.rows("events", "event_type IN ('click', 'view') AND value IS NULL")),
}

AUDIT = sql.audit(star.CHECKS, CHECKS)

RUN_LOG = """(
SELECT event_id AS run_id, 'validation' AS run_type, ts AS started_at,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'failed_checks' ELSE 'success' END AS status,
  CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 19 END AS BIGINT) AS checks_total,
  CAST(CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END AS BIGINT) AS checks_failed,
  CASE WHEN event_type = 'error' THEN substring(props, 1, 500) END AS error_message
FROM events)"""


def _rate(group: str, hit: str, source: str, key: str, whole: str, hits: str, rate: str, digits: int) -> str:
    counts = f"SELECT {group} AS {key}, count(*) AS n, CAST(count_if({hit}) AS BIGINT) AS h FROM {source} GROUP BY 1"
    return f"SELECT {key}, n AS {whole}, h AS {hits}, {sql.percent('h', 'n', digits)} AS {rate} FROM ({counts})"


REPORTS = {
    "star_days_to_ship_by_priority": f"""
SELECT o_orderpriority, count(*) AS shipped_lines,
  {sql.ratio("sum(date_diff('day', o_orderdate, l_shipdate))", "count(*)", 1)} AS avg_days_to_ship
FROM {SHIPMENTS} WHERE l_shipdate >= o_orderdate GROUP BY 1""",
    "star_finish_rate_by_month": _rate(
        sql.month("o_orderdate"), "o_orderstatus = 'F'", "orders",
        "order_month", "orders_placed", "orders_finished", "finish_rate_pct", 1,
    ),
    "star_event_funnel": """
SELECT count(*) AS entered, count(*) FILTER (event_type IN ('click', 'signup', 'purchase')) AS clicked,
  count(*) FILTER (event_type IN ('signup', 'purchase')) AS signed_up,
  count(*) FILTER (event_type = 'purchase') AS purchased
FROM events""",
    "star_purchase_rate_by_segment": _rate(
        "c_mktsegment", "event_type = 'purchase'", "events JOIN customer ON user_id = c_custkey",
        "c_mktsegment", "events", "purchases", "purchase_rate_pct", 2,
    ),
    "star_cost_per_purchase_by_segment": f"""
WITH bought AS (
  SELECT c_mktsegment AS seg, count(*) AS n FROM events JOIN customer ON user_id = c_custkey
  WHERE event_type = 'purchase' GROUP BY 1
), spent AS (
  SELECT c_mktsegment AS seg, sum({sql.dec('o_totalprice')}) AS s FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY 1
)
SELECT seg AS c_mktsegment, n AS purchases, CAST(round(s, 2) AS DOUBLE) AS total_spend,
  {sql.ratio('(s * 10000)', '(n * 10000)', 2)} AS cost_per_purchase
FROM bought LEFT JOIN spent USING (seg)""",
    "star_monthly_order_value": f"""
SELECT {sql.month('o_orderdate')} AS order_month, count(*) AS orders, {sql.total('o_totalprice')} AS order_value,
  {sql.mean('o_totalprice')} AS avg_value
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
    "star_orders_by_status": f"""
SELECT o_orderstatus, count(*) AS orders, {sql.total('o_totalprice')} AS total_value FROM orders GROUP BY 1""",
    "star_finish_ratio": f"""
SELECT f AS finished, p AS pending, {sql.percent('f', '(f + p)', 1)} AS finish_pct
FROM (SELECT count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders)""",
    "recent_runs": f"""
SELECT started_at, run_type, status, checks_total, checks_failed, error_message
FROM {RUN_LOG} ORDER BY started_at DESC, run_id DESC LIMIT 20""",
    "problem_rate_by_day": _rate(
        "CAST(started_at AS DATE)", "status <> 'success'", RUN_LOG,
        "run_date", "runs", "runs_with_problems", "problem_rate_pct", 1,
    ),
    "star_audit_checks": AUDIT,
    "star_audit_by_branch": AUDIT,
    "star_failing_checks": sql.failing(AUDIT),
    "star_audit_overview": AUDIT,
}

SINGLE_CHECKS = {
    f"check_{c.check_name}": sql.audit([c], CHECKS) for c in [*star.CHECKS, star.LINE_PARTS, star.RATED_CUSTOMERS]
}
