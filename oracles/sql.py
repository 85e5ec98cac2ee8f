"""SQL fragments shared by the oracle queries.

Ratios and means are rounded with whole numbers, half up, so the SQL side has no binary
rounding of its own. Counts are cast to BIGINT, dates to DATE.
"""

from __future__ import annotations


def dec(amount: str) -> str:
    return f"CAST({amount} AS DECIMAL(28,10))"


def total(amount: str) -> str:
    """Exact total as DOUBLE with two decimals."""
    return f"CAST(round(sum({dec(amount)}), 2) AS DOUBLE)"


def ratio(top: str, bottom: str, digits: int) -> str:
    """top / bottom rounded half up to ``digits``; both whole and not negative."""
    scale = 10**digits
    return (
        f"CAST((2 * {scale} * CAST({top} AS HUGEINT) + {bottom}) // (2 * NULLIF({bottom}, 0)) AS DOUBLE) / {scale}"
    )


def percent(part: str, whole: str, digits: int) -> str:
    return ratio(f"(100 * {part})", whole, digits)


def units(amount: str) -> str:
    """Total of ``amount`` in 1/10000 as a whole number."""
    return f"CAST(round(sum({dec(amount)}) * 10000, 0) AS HUGEINT)"


def mean(amount: str, digits: int = 2) -> str:
    return ratio(units(amount), f"(10000 * count({amount}))", digits)


def month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def number_text(value: str) -> str:
    """A DOUBLE as text without a trailing ``.0``; NULL as ``null``."""
    return f"coalesce(regexp_replace(CAST({value} AS VARCHAR), '\\.0$', ''), 'null')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def audit(checks, values: dict[str, tuple[str, str]]) -> str:
    """Scored audit rows from (expected, actual) scalar SQL per check name."""
    rows = []
    for c in checks:
        expected, actual = values[c.check_name]
        rows.append(
            f"SELECT {quoted(c.check_type)} AS check_type, {quoted(c.check_name)} AS check_name, "
            f"{quoted(c.description)} AS description, "
            f"CAST({expected} AS DECIMAL(38,4)) AS e, CAST({actual} AS DECIMAL(38,4)) AS a"
        )
    union = "\nUNION ALL ".join(rows)
    return (
        "SELECT check_type, check_name, description, CAST(e AS DOUBLE) AS expected, CAST(a AS DOUBLE) AS actual, "
        "CAST(a - e AS DOUBLE) AS difference, "
        "CASE WHEN abs(a - e) < 0.005 THEN 'PASS' ELSE 'FAIL' END AS status\n"
        f"FROM (\n{union}\n)"
    )


def orphans(child: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"(SELECT count(*) FROM {child} AS x WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent} AS y WHERE y.{parent_key} = x.{key}))"
    )


def surplus(table: str, key: str) -> str:
    return f"(SELECT count(*) - count(DISTINCT {key}) FROM {table})"


def rows(table: str, where: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def summed(table: str, amount: str) -> str:
    return f"(SELECT sum({dec(amount)}) FROM {table})"


def by_month(table: str, amount: str, day: str) -> str:
    return (
        f"(SELECT sum(s) FROM (SELECT {month(day)} AS m, sum({dec(amount)}) AS s FROM {table} GROUP BY 1) "
        "WHERE m IS NOT NULL)"
    )


# --- summaries of an audit, given its SQL ---------------------------------------------


def failing(audit_sql: str) -> str:
    return f"SELECT check_type, check_name, expected, actual, status FROM ({audit_sql}) WHERE status = 'FAIL'"


def summary(audit_sql: str) -> str:
    return (
        "SELECT CASE WHEN count(*) FILTER (status <> 'PASS') > 0 THEN 'failed_checks' ELSE 'success' END AS status, "
        "count(*) AS total, count(*) FILTER (status <> 'PASS') AS failed, "
        f"count(*) FILTER (status = 'PASS') AS passed FROM ({audit_sql})"
    )


def alert(audit_sql: str, project: str) -> str:
    return f"""
WITH audit AS ({audit_sql}),
bad AS (SELECT *, row_number() OVER (ORDER BY check_type, check_name) AS n FROM audit WHERE status <> 'PASS'),
lines AS (
  SELECT string_agg('• ' || check_name || ': expected ' || {number_text('expected')}
                    || ', got ' || {number_text('actual')}, chr(10) ORDER BY n) AS body
  FROM bad WHERE n <= 10
)
SELECT '⚠️ Data validation failed ({project})' || chr(10) || chr(10)
       || CAST((SELECT count(*) FROM bad) AS VARCHAR) || ' of ' || CAST((SELECT count(*) FROM audit) AS VARCHAR)
       || ' checks failed (run status: failed_checks).' || chr(10) || chr(10) || body AS message
FROM lines WHERE (SELECT count(*) FROM bad) > 0"""


def console(audit_sql: str) -> str:
    def python_text(value: str) -> str:
        return f"coalesce(CAST({value} AS VARCHAR), 'None')"

    return (
        f"SELECT '  FAIL ' || check_name || ': expected ' || {python_text('expected')} || ', got ' "
        f"|| {python_text('actual')} AS message FROM ({audit_sql}) WHERE status <> 'PASS'"
    )
