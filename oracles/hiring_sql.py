"""Oracle SQL on the hiring tables, which it derives from the star tables itself."""

from __future__ import annotations

from hirelattice.plans import hiring, recruiting

from . import sql

_CHANNELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in hiring.PART_CHANNELS.items())
_STAGES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in hiring.DEAL_STAGES.items())
_END = f"DATE '{hiring.HORIZON}'"

VACANCIES = f"""
opened AS (
  SELECT *, greatest(CAST(o_orderdate AS DATE), DATE '{hiring.FIRST_DAY}') AS opened_at,
    CAST(greatest(least(floor(o_totalprice / 4000), 100), 10) AS INTEGER) AS days
  FROM orders
),
ended AS (
  SELECT *, CASE WHEN o_orderstatus <> 'O' THEN CAST(opened_at + days AS DATE) END AS ends FROM opened
),
vacancies AS (
  SELECT printf('v_%04d', o_orderkey + 1) AS vacancy_id, printf('c_%03d', o_custkey + 1) AS client_id,
    o_orderpriority AS role_title, o_orderpriority AS department,
    CASE WHEN o_totalprice < 150000 THEN 'junior' WHEN o_totalprice < 350000 THEN 'mid' ELSE 'senior' END AS seniority,
    opened_at, CASE WHEN ends <= {_END} THEN ends END AS closed_at,
    CASE WHEN ends > {_END} OR o_orderstatus = 'O' THEN 'open'
         WHEN o_orderstatus = 'F' THEN 'filled' ELSE 'cancelled' END AS status,
    CAST(floor(o_totalprice / 1000) * 10 AS BIGINT) AS salary_offered_usd_month
  FROM ended
)"""

APPLICATIONS = """
lines AS (
  SELECT l_orderkey, l_partkey, printf('v_%04d', l_orderkey + 1) AS vacancy_id, printf('cand_%05d', l_partkey + 1) AS candidate_id,
    CAST(l_shipdate AS DATE) AS applied_at,
    CASE WHEN l_returnflag = 'A' THEN 'applied' WHEN l_returnflag = 'N' THEN 'screened'
         WHEN l_linestatus = 'O' THEN 'interview' ELSE 'offer' END AS stage
  FROM lineitem
),
drawn AS (
  SELECT printf('app_%06d', application_no) AS application_id, *
  FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, applied_at, stage) AS application_no FROM lines)
),
chosen AS (
  SELECT l_orderkey, min(application_no) AS application_no FROM drawn
  WHERE vacancy_id IN (SELECT vacancy_id FROM vacancies WHERE status = 'filled') GROUP BY 1
),
applications AS (
  SELECT application_id, vacancy_id, candidate_id, applied_at,
    CASE WHEN application_no IN (SELECT application_no FROM chosen) THEN 'hired' ELSE stage END AS furthest_stage
  FROM drawn
)"""

CANDIDATES = f"""
candidates AS (
  SELECT candidate_id, p_brand AS country, CASE p_type {_CHANNELS} END AS source_channel, created_at
  FROM (SELECT candidate_id, min(applied_at) AS created_at FROM applications GROUP BY 1)
  LEFT JOIN part ON p_partkey = CAST(substring(candidate_id, 6) AS BIGINT) - 1
)"""

PLACEMENTS = """
placements AS (
  SELECT printf('p_%04d', row_number() OVER (ORDER BY CAST(substring(v.vacancy_id, 3) AS BIGINT))) AS placement_id, v.vacancy_id, a.candidate_id,
    v.closed_at AS placed_at, v.salary_offered_usd_month AS monthly_salary_usd,
    CAST(v.salary_offered_usd_month * 1.25 AS DOUBLE) AS placement_fee_usd
  FROM vacancies AS v JOIN applications AS a ON a.vacancy_id = v.vacancy_id AND a.furthest_stage = 'hired'
)"""

MARKETING = f"""
marketing_daily AS (
  SELECT day AS "date", channel,
    CASE WHEN isodow(day) <= 5 THEN 'weekday push' ELSE 'weekend push' END AS campaign_name,
    CAST(coalesce(sum({sql.dec('value')}), 0) AS DOUBLE) AS spend_usd, count(e.event_id) * 40 AS impressions,
    count(e.event_id) AS clicks, count(e.event_id) FILTER (e.value > 50) AS leads
  FROM (
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
    FROM (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events)
  ) AS days
  CROSS JOIN (SELECT DISTINCT event_type AS channel FROM events) AS channels
  LEFT JOIN events AS e ON CAST(e.ts AS DATE) = day AND e.event_type = channel
  GROUP BY 1, 2, 3
)"""

CLIENTS = """
clients AS (
  SELECT printf('c_%03d', c_custkey + 1) AS client_id, c_name AS company_name, c_mktsegment AS industry,
    'nation ' || CAST(c_nationkey AS VARCHAR) AS country, CAST(DATE '1994-01-01' + c_nationkey AS DATE) AS signed_at
  FROM customer
)"""

DEALS = f"""
staged AS (
  SELECT *, CASE c_mktsegment {_STAGES} END AS drawn, CAST(DATE '2001-01-01' + c_nationkey * 6 AS DATE) AS created_at,
    CAST(DATE '2001-01-01' + c_nationkey * 6 + 45 AS DATE) AS ends
  FROM customer
),
sales_deals AS (
  SELECT printf('d_%04d', c_custkey + 1) AS deal_id, 'rep ' || CAST(c_nationkey AS VARCHAR) AS owner,
    CASE WHEN drawn <> 'open' AND ends > {_END} THEN 'open' ELSE drawn END AS stage, abs(c_acctbal) AS amount_usd,
    created_at, CASE WHEN drawn <> 'open' AND ends <= {_END} THEN ends END AS closed_at,
    CASE WHEN drawn = 'won' AND ends <= {_END} THEN printf('c_%03d', c_custkey + 1) END AS client_id
  FROM staged
)"""

BASE = "WITH " + ",".join([VACANCIES, APPLICATIONS, CANDIDATES, PLACEMENTS, MARKETING, CLIENTS, DEALS])

# The five faults as replacement tables: "first" is the smallest key.
FAULTS = f"""{BASE},
rarest AS (SELECT client_id, count(*) AS n FROM vacancies GROUP BY 1 ORDER BY n, client_id LIMIT 1),
bad_clients AS (SELECT * FROM clients WHERE client_id NOT IN (SELECT client_id FROM rarest)),
bad_placements AS (
  SELECT * FROM placements UNION ALL (SELECT * FROM placements ORDER BY CAST(substring(placement_id, 3) AS BIGINT) LIMIT 1)
),
bad_vacancies AS (
  SELECT * REPLACE (CASE WHEN vacancy_id = (SELECT vacancy_id FROM vacancies WHERE status = 'filled' ORDER BY CAST(substring(vacancy_id, 3) AS BIGINT) LIMIT 1)
                         THEN NULL ELSE closed_at END AS closed_at) FROM vacancies
),
bad_marketing AS (
  SELECT * REPLACE (CASE WHEN row_number() OVER (ORDER BY "date", channel) <= 3
                         THEN -abs(spend_usd) ELSE spend_usd END AS spend_usd) FROM marketing_daily
),
bad_deals AS (
  SELECT * REPLACE (CASE WHEN deal_id = (SELECT deal_id FROM sales_deals WHERE stage = 'won' ORDER BY CAST(substring(deal_id, 3) AS BIGINT) LIMIT 1)
                         THEN NULL ELSE client_id END AS client_id) FROM sales_deals
)"""


def _checks(clients="clients", vacancies="vacancies", placements="placements", marketing="marketing_daily",
            deals="sales_deals") -> dict[str, tuple[str, str]]:
    filled = f"{placements} AS p JOIN {vacancies} AS v ON v.vacancy_id = p.vacancy_id AND v.status = 'filled'"
    fees = sql.summed(placements, "placement_fee_usd")
    return {
        "orphan_vacancies_client": ("0", sql.orphans(vacancies, "client_id", clients, "client_id")),
        "orphan_applications_vacancy": ("0", sql.orphans("applications", "vacancy_id", vacancies, "vacancy_id")),
        "orphan_applications_candidate": ("0", sql.orphans("applications", "candidate_id", "candidates", "candidate_id")),
        "orphan_placements_vacancy": ("0", sql.orphans(placements, "vacancy_id", vacancies, "vacancy_id")),
        "orphan_placements_candidate": ("0", sql.orphans(placements, "candidate_id", "candidates", "candidate_id")),
        "duplicate_vacancy_id": ("0", sql.surplus(vacancies, "vacancy_id")),
        "duplicate_application_id": ("0", sql.surplus("applications", "application_id")),
        "duplicate_placement_id": ("0", sql.surplus(placements, "placement_id")),
        "placements_vs_filled_vacancies": (sql.rows(vacancies, "status = 'filled'"), sql.rows(placements)),
        "hired_applications_vs_placements": (
            sql.rows("applications", "furthest_stage = 'hired'"), sql.rows(placements),
        ),
        "placements_without_hired_application": (
            "0",
            f"(SELECT count(*) FROM {placements} AS p WHERE NOT EXISTS (SELECT 1 FROM applications AS a WHERE "
            "a.furthest_stage = 'hired' AND a.vacancy_id = p.vacancy_id AND a.candidate_id = p.candidate_id))",
        ),
        "revenue_total_vs_monthly_report": (fees, sql.by_month(placements, "placement_fee_usd", "placed_at")),
        "revenue_total_vs_filled_vacancies": (fees, sql.summed(filled, "p.placement_fee_usd")),
        "filled_vacancies_missing_close_date": ("0", sql.rows(vacancies, "status = 'filled' AND closed_at IS NULL")),
        "open_vacancies_with_close_date": ("0", sql.rows(vacancies, "status = 'open' AND closed_at IS NOT NULL")),
        "closed_before_opened": ("0", sql.rows(vacancies, "closed_at < opened_at")),
        "negative_or_missing_marketing_spend": ("0", sql.rows(marketing, "spend_usd IS NULL OR spend_usd < 0")),
        "clicks_exceed_impressions": ("0", sql.rows(marketing, "clicks > impressions")),
        "won_deals_without_client": ("0", sql.rows(deals, "stage = 'won' AND client_id IS NULL")),
        "closed_deals_without_close_date": ("0", sql.rows(deals, "stage IN ('won', 'lost') AND closed_at IS NULL")),
    }


AUDIT = f"{BASE}\n{sql.audit(recruiting.CHECKS, _checks())}"
GATE = f"{BASE}\n{sql.audit(recruiting.GATE, _checks())}"
_FAULTY = _checks("bad_clients", "bad_vacancies", "bad_placements", "bad_marketing", "bad_deals")
FAULT_AUDIT = f"{FAULTS}\n" + sql.audit(recruiting.CHECKS, _FAULTY)
FAULT_GATE = f"{FAULTS}\n{sql.audit(recruiting.GATE, _FAULTY)}"


def _q(text: str) -> str:
    return f"{BASE}\n{text}"


REPORTS = {
    "time_to_fill_by_department": _q(f"""
SELECT department, count(*) AS filled_vacancies,
  {sql.ratio("sum(closed_at - opened_at)", "count(closed_at)", 1)} AS avg_days_to_fill
FROM vacancies WHERE status = 'filled' GROUP BY 1"""),
    "fill_rate_by_open_month": _q(f"""
SELECT m AS opened_month, n AS vacancies_opened, h AS vacancies_filled, {sql.percent('h', 'n', 1)} AS fill_rate_pct
FROM (SELECT {sql.month('opened_at')} AS m, count(*) AS n, count(*) FILTER (status = 'filled') AS h
      FROM vacancies GROUP BY 1)"""),
    "hiring_funnel": _q("""
SELECT count(*) AS applied, count(*) FILTER (furthest_stage IN ('screened', 'interview', 'offer', 'hired')) AS screened,
  count(*) FILTER (furthest_stage IN ('interview', 'offer', 'hired')) AS interviewed,
  count(*) FILTER (furthest_stage IN ('offer', 'hired')) AS offered,
  count(*) FILTER (furthest_stage = 'hired') AS hired
FROM applications"""),
    "hire_rate_by_channel": _q(f"""
SELECT source_channel, n AS applications, h AS hires, {sql.percent('h', 'n', 2)} AS hire_rate_pct
FROM (SELECT source_channel, count(*) AS n, count(*) FILTER (furthest_stage = 'hired') AS h
      FROM applications JOIN candidates USING (candidate_id) GROUP BY 1)"""),
    "cost_per_hire_by_channel": _q(f"""
SELECT channel, n AS hires, CAST(round(s, 2) AS DOUBLE) AS total_spend_usd,
  {sql.ratio('(s * 10000)', '(n * 10000)', 2)} AS cost_per_hire_usd
FROM (SELECT source_channel AS channel, count(*) AS n FROM applications JOIN candidates USING (candidate_id)
      WHERE furthest_stage = 'hired' GROUP BY 1)
LEFT JOIN (SELECT channel, sum({sql.dec('spend_usd')}) AS s FROM marketing_daily GROUP BY 1) USING (channel)"""),
    "monthly_revenue": _q(f"""
SELECT {sql.month('placed_at')} AS placement_month, count(*) AS placements, {sql.total('placement_fee_usd')} AS revenue_usd,
  {sql.mean('placement_fee_usd')} AS avg_fee_usd
FROM placements GROUP BY 1"""),
    "deals_by_stage": _q(f"""
SELECT stage, count(*) AS deals, {sql.total('amount_usd')} AS total_amount_usd FROM sales_deals GROUP BY 1"""),
    "win_rate": _q(f"""
SELECT w AS won, l AS lost, {sql.percent('w', '(w + l)', 1)} AS win_rate_pct
FROM (SELECT count(*) FILTER (stage = 'won') AS w, count(*) FILTER (stage = 'lost') AS l FROM sales_deals)"""),
    "audit_checks": AUDIT,
    "failing_checks": sql.failing(AUDIT),
    "integrity_gate_checks": GATE,
    "fault_audit_checks": FAULT_AUDIT,
    "fault_report": f"""{FAULTS}
SELECT 'drop_rarest_parent: clients' AS issue, n AS rows_affected FROM rarest
UNION ALL SELECT 'duplicate_first: placements', (SELECT count(*) FROM bad_placements) - (SELECT count(*) FROM placements)
UNION ALL SELECT 'clear_on_first: vacancies',
  count(*) FILTER (status = 'filled' AND closed_at IS NULL) FROM bad_vacancies
UNION ALL SELECT 'negate_first: marketing_daily', count(*) FILTER (spend_usd < 0) FROM bad_marketing
UNION ALL SELECT 'clear_on_first: sales_deals', count(*) FILTER (stage = 'won' AND client_id IS NULL) FROM bad_deals""",
    "fault_clients": f"{FAULTS} SELECT * FROM bad_clients",
    "fault_placements": f"{FAULTS} SELECT * FROM bad_placements",
    "fault_vacancies": f"{FAULTS} SELECT * FROM bad_vacancies",
    "fault_marketing": f"{FAULTS} SELECT * FROM bad_marketing",
    "fault_deals": f"{FAULTS} SELECT * FROM bad_deals",
    "fault_orphaned_vacancies": (
        f"{FAULTS} SELECT * FROM vacancies WHERE client_id NOT IN (SELECT client_id FROM bad_clients)"
    ),
    **{
        f"hiring_{name}": _q(f"SELECT * FROM {name}")
        for name in ["clients", "vacancies", "candidates", "applications", "placements", "marketing_daily", "sales_deals"]
    },
}
