"""Validation runs: execute an audit, summarise it, log it and phrase the alert.

Everything here works on the audit table, which has one row per check; that number is
fixed by the catalogue, so summaries and messages may gather all of its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar_day, plain_number
from ..operators.metrics import latest_rows, rate_by
from ..schemas import FAILURE, PAYLOAD, RUN_LOG
from ..sources.tables import append_table, replace_table
from .audit import stamp_checked

# Fixed values of the run log, the summary and the message.
RUN_TYPE = "validation"
SUCCESS, FAILED_CHECKS, ERROR = "success", "failed_checks", "error"
ERROR_TYPE, ERROR_NAME = "error", "pipeline_error"
ERROR_LENGTH = 500
RECENT_RUNS = 20
MESSAGE_FAILURES = 10
ALERT_HEADER = "⚠️ Data validation failed (%s)"
ALERT_COUNTS = "%d of %d checks failed (run status: %s)."
ALERT_BULLET = "• "
FAIL_LINE, ERROR_LINE = "  FAIL ", "  ERROR "
EXPECTED, GOT = "expected ", ", got "

AUDIT_COLUMNS = ["check_type", "check_name", "description", "expected", "actual", "status"]


def read_audit(audit: DataFrame) -> DataFrame:
    """The audit as reports read it: six columns in check order."""
    return audit.select(*AUDIT_COLUMNS).orderBy("check_type", "check_name")


def audit_overview(audit: DataFrame) -> DataFrame:
    """Full audit ordered by status (descending), then type and name."""
    return audit.orderBy(F.desc("status"), "check_type", "check_name")


def _failing() -> Column:
    return ~F.col("status").eqNullSafe("PASS")


def failing_checks(audit: DataFrame) -> DataFrame:
    """Checks that fail, in check order."""
    return (
        audit.where(F.col("status") == "FAIL")
        .select("check_type", "check_name", "expected", "actual", "status")
        .orderBy("check_type", "check_name")
    )


def summarise(audit: DataFrame, run_id: str, project: str, source: str = RUN_TYPE) -> DataFrame:
    """One nested row: status, counts and the failing checks in check order."""
    failure = F.struct(*[F.col(c) for c in FAILURE.fieldNames()])
    counted = audit.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_failing()).alias("failed"),
        # A struct sorts by its first fields: check type, then check name.
        F.array_sort(F.collect_list(F.when(_failing(), failure))).alias("failures"),
    )
    return counted.select(
        F.lit(source).alias("source"),
        F.lit(project).alias("project"),
        F.lit(run_id).alias("run_id"),
        F.when(F.col("failed") > 0, F.lit(FAILED_CHECKS)).otherwise(F.lit(SUCCESS)).alias("status"),
        "total",
        "failed",
        (F.col("total") - F.col("failed")).alias("passed"),
        "failures",
    )


def summarise_error(
    spark: SparkSession, error: str, run_id: str, project: str, source: str = RUN_TYPE
) -> DataFrame:
    """The summary of a run that broke: no checks, one failure that carries the message."""
    failure = (ERROR_TYPE, ERROR_NAME, error, None, None, "FAIL")
    row = (source, project, run_id, ERROR, 0, 1, 0, [failure])
    return spark.createDataFrame([row], PAYLOAD)


def payload_json(payload: DataFrame) -> DataFrame:
    """The summary as JSON text, missing values kept as null."""
    return payload.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("body"))


def _utc_seconds(instant: datetime) -> Column:
    return F.lit(instant.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S+00:00")).cast("timestamp")


def run_record(payload: DataFrame, started: datetime, finished: datetime) -> DataFrame:
    """The run log row of a summary; the message is cut to the column's length."""
    message = F.when(
        F.col("status") == ERROR, F.substring(F.col("failures")[0]["description"], 1, ERROR_LENGTH)
    )
    columns = {
        "run_id": F.col("run_id"),
        "run_type": F.col("source"),
        "started_at": _utc_seconds(started),
        "finished_at": _utc_seconds(finished),
        "status": F.col("status"),
        "checks_total": F.col("total"),
        "checks_failed": F.col("failed"),
        "error_message": message,
    }
    return payload.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in RUN_LOG.fields])


def _expected_got(failure: Column, missing: str, **style) -> Column:
    return F.concat(
        F.lit(EXPECTED), plain_number(failure["expected"], missing, **style),
        F.lit(GOT), plain_number(failure["actual"], missing, **style),
    )


def _known(part: Column) -> Column:
    """A part of a message; a missing one shows as null instead of hiding the line."""
    return F.coalesce(part, F.lit("null"))


# Numbers on the console: a point in whole ones, exponents of two digits from 1e16 and below 1e-4.
_CONSOLE = {"whole_suffix": ".0", "plain_from": 1e-4, "plain_below": 1e16, "exponent_digits": 2}


def console_lines(payload: DataFrame) -> DataFrame:
    """One line per failure, as an operator would print it."""
    failure = F.col("failure")
    name, description = _known(failure["check_name"]), _known(failure["description"])
    plain = F.concat(F.lit(FAIL_LINE), name, F.lit(": "), _expected_got(failure, "None", **_CONSOLE))
    broken = F.concat(F.lit(ERROR_LINE), description)
    return payload.select(F.explode("failures").alias("failure")).select(
        F.when(failure["check_type"] == ERROR_TYPE, broken).otherwise(plain).alias("message")
    )


def needs_alert() -> Column:
    return F.col("failed") > 0


def alert_message(payload: DataFrame) -> DataFrame:
    """The alert of every summary with failures: header, counts, the first ten failures."""

    def bullet(failure: Column) -> Column:
        detail = F.when(failure["check_type"] == ERROR_TYPE, _known(failure["description"])).otherwise(
            _expected_got(failure, "null")
        )
        return F.concat(F.lit(ALERT_BULLET), _known(failure["check_name"]), F.lit(": "), detail)

    header = F.format_string(ALERT_HEADER, F.col("project"))
    counts = F.format_string(ALERT_COUNTS, F.col("failed"), F.col("total"), F.col("status"))
    bullets = F.array_join(F.transform(F.slice("failures", 1, MESSAGE_FAILURES), bullet), "\n")
    text = F.concat_ws("\n\n", header, counts, bullets)
    return payload.where(needs_alert()).select("run_id", text.alias("message"))


@dataclass(frozen=True)
class RunOutcome:
    """What a validation run leaves behind.

    ``log_error`` is set when the log failed, ``cause`` to what broke an ``error`` run.
    """

    status: str
    payload: DataFrame
    record: DataFrame
    log_error: str | None = None
    cause: Exception | None = None


def run_validation(
    spark: SparkSession, build_audit: Callable[[], DataFrame], *,
    audit_table: str, run_log: str, project: str,
) -> RunOutcome:
    """Rebuild the audit table, summarise it and append one row to the run log.

    Anything that breaks on the way to the summary makes an ``error`` run, which is
    logged as well; a run log that cannot be written does not hide the result. The audit
    is written before it is read, so the checks run exactly once. A run is logged once, however often its
    record is appended.
    """
    run_id = str(uuid.uuid4())
    started = datetime.now(timezone.utc)
    cause = None
    try:
        replace_table(stamp_checked(build_audit()), audit_table)
        # One row holding at most one entry per check: fixed here, reused below.
        summary = summarise(spark.table(audit_table), run_id, project).first()
        payload = spark.createDataFrame([summary], PAYLOAD)
        status = summary["status"]
    except Exception as broken:
        payload = summarise_error(spark, str(broken)[:ERROR_LENGTH], run_id, project)
        status, cause = ERROR, broken
    record = run_record(payload, started, datetime.now(timezone.utc))
    try:
        append_table(record, run_log, once=["run_id"])
    except Exception as broken:
        return RunOutcome(status, payload, record, str(broken), cause)
    return RunOutcome(status, payload, record, cause=cause)


def recent_runs(run_log: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    """The newest runs; equal start times are ordered by run id."""
    columns = ["started_at", "run_type", "status", "checks_total", "checks_failed", "error_message"]
    return latest_rows(run_log, "started_at", "run_id", columns, n)


def problem_rate_by_day(run_log: DataFrame) -> DataFrame:
    """Runs and the share that did not succeed per UTC day, newest first."""
    return rate_by(
        run_log, calendar_day("started_at").alias("run_date"), F.col("status") != SUCCESS,
        total="runs", hits="runs_with_problems", rate="problem_rate_pct", digits=1,
    ).orderBy(F.desc("run_date"))
