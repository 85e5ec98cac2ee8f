"""Validation runs, the run log, summaries, alerts and the alert stream."""

import json
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from hirelattice.plans import recruiting, runs
from hirelattice.schemas import AUDIT, PAYLOAD, RUN_LOG
from hirelattice.sources.tables import create_namespace
from hirelattice.streaming import alerts

from .conftest import collected


def audit_rows(spark, rows):
    stamped = [(t, n, "", e, a, None if a is None or e is None else a - e, s, None) for t, n, e, a, s in rows]
    return spark.createDataFrame(stamped, AUDIT)


def validate(spark, name, build):
    create_namespace(spark, name)
    return runs.run_validation(
        spark, build, audit_table=f"{name}.audit_checks", run_log=f"{name}.pipeline_runs", project="agency"
    )


def test_a_successful_run(spark, clean):
    outcome = validate(spark, "good_run", lambda: recruiting.audit_checks(clean))
    payload = outcome.payload.first()
    assert (outcome.status, payload.total, payload.failed, payload.passed, payload.failures) == ("success", 19, 0, 19, [])
    assert outcome.log_error is None
    assert spark.table("good_run.audit_checks").schema.names == AUDIT.names
    assert spark.table("good_run.audit_checks").select("checked_at").distinct().count() == 1
    assert runs.alert_message(outcome.payload).count() == 0


def test_two_runs_leave_two_log_rows(spark, clean):
    faulty = recruiting.inject_faults(clean)
    for _ in range(2):
        outcome = validate(spark, "two_runs", lambda: recruiting.audit_checks(faulty))
    log = spark.table("two_runs.pipeline_runs")
    assert [f.dataType for f in log.schema] == [f.dataType for f in RUN_LOG]
    assert log.select("run_id").distinct().count() == 2
    assert {tuple(r) for r in log.select("run_type", "status", "checks_total", "checks_failed", "error_message").collect()} == {
        ("validation", "failed_checks", 19, 7, None)
    }
    assert spark.table("two_runs.audit_checks").count() == 19
    failures = outcome.payload.first().failures
    assert [f.check_name for f in failures] == [r.check_name for r in runs.failing_checks(spark.table("two_runs.audit_checks")).collect()]


def test_a_broken_run_is_logged(spark, clean):
    missing = {k: v for k, v in clean.items() if k != "clients"}
    outcome = validate(spark, "broken_run", lambda: recruiting.audit_checks(missing))
    payload = outcome.payload.first()
    assert (outcome.status, payload.total, payload.failed, payload.passed) == ("error", 0, 1, 0)
    assert payload.failures[0].check_name == "pipeline_error"
    record = spark.table("broken_run.pipeline_runs").first()
    assert (record.status, record.checks_total, record.checks_failed) == ("error", 0, 1)
    assert "clients" in record.error_message
    message = runs.alert_message(outcome.payload).first().message
    assert "1 of 0 checks failed (run status: error)." in message
    assert message.endswith("• pipeline_error: " + record.error_message)
    assert collected(runs.console_lines(outcome.payload)) == [("  ERROR " + record.error_message,)]


def test_long_errors_are_cut(spark):
    payload = runs.summarise_error(spark, "x" * 700, "id", "agency")
    now = datetime.now(timezone.utc)
    assert len(runs.run_record(payload, now, now).first().error_message) == 500


def test_a_log_failure_does_not_hide_the_result(spark, clean):
    create_namespace(spark, "no_log")
    outcome = runs.run_validation(
        spark, lambda: recruiting.audit_checks(clean),
        audit_table="no_log.audit_checks", run_log="no_such_namespace.log", project="agency",
    )
    assert outcome.status == "success"
    assert outcome.log_error


def test_run_times_are_utc_seconds(spark):
    payload = runs.summarise_error(spark, "x", "id", "agency")
    at = datetime(2025, 3, 1, 12, 30, 15, 999999, tzinfo=timezone.utc)
    record = runs.run_record(payload, at, at)
    assert record.select(F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSS")).first()[0] == "2025-03-01 12:30:15.000"


def test_json_keeps_nulls(spark):
    body = runs.payload_json(runs.summarise_error(spark, "boom", "id", "agency")).first().body
    parsed = json.loads(body)
    assert list(parsed) == PAYLOAD.names
    assert parsed["failures"] == [
        {"check_type": "error", "check_name": "pipeline_error", "description": "boom",
         "expected": None, "actual": None, "status": "FAIL"}
    ]


def test_alert_text(spark):
    audit = audit_rows(spark, [
        ("validity", "b", 0.0, 280.0, "FAIL"), ("integrity", "z", 0.0, 3.0, "FAIL"),
        ("reconciliation", "m", 3758439620.06, None, "FAIL"), ("integrity", "ok", 0.0, 0.0, "PASS"),
    ])
    payload = runs.summarise(audit, "id", "agency")
    assert runs.alert_message(payload).first().message == (
        "⚠️ Data validation failed (agency)\n\n3 of 4 checks failed (run status: failed_checks).\n\n"
        "• z: expected 0, got 3\n• m: expected 3758439620.06, got null\n• b: expected 0, got 280"
    )
    assert collected(runs.console_lines(payload))[1] == ("  FAIL m: expected 3758439620.06, got None",)


def test_alert_names_at_most_ten(spark):
    audit = audit_rows(spark, [("t", f"c{i:02d}", 0.0, 1.0, "FAIL") for i in range(12)])
    message = runs.alert_message(runs.summarise(audit, "id", "agency")).first().message
    assert "12 of 12 checks failed" in message
    assert message.count("•") == 10 and "c09" in message and "c10" not in message


def test_unknown_status_counts_as_failure(spark):
    payload = runs.summarise(audit_rows(spark, [("t", "n", 0.0, 0.0, None)]), "id", "agency").first()
    assert (payload.failed, payload.status) == (1, "failed_checks")


def test_overview_order(spark):
    audit = audit_rows(spark, [("b", "x", 0.0, 1.0, "FAIL"), ("a", "y", 0.0, 0.0, "PASS"), ("a", "x", 0.0, 0.0, "PASS")])
    assert [(r.status, r.check_type, r.check_name) for r in runs.audit_overview(audit).collect()] == [
        ("PASS", "a", "x"), ("PASS", "a", "y"), ("FAIL", "b", "x")
    ]


def test_run_reports(spark):
    rows = [
        (f"r{i:02d}", "validation", datetime(2025, 1, 1 + i // 12, tzinfo=timezone.utc), None,
         ["success", "failed_checks", "error", "success"][i % 4], 19, 0, None) for i in range(24)
    ]
    log = spark.createDataFrame(rows, RUN_LOG)
    days = runs.problem_rate_by_day(log).collect()
    assert [(str(r.run_date), r.runs, r.runs_with_problems, r.problem_rate_pct) for r in days] == [
        ("2025-01-02", 12, 6, 50.0), ("2025-01-01", 12, 6, 50.0)
    ]
    assert runs.recent_runs(log).count() == 20


@pytest.fixture
def stream_folders(tmp_path):
    return [str(tmp_path / n) for n in ("summaries", "alerts", "progress")]


def test_alert_stream_sends_each_failure_once(spark, stream_folders):
    published, sent, progress = stream_folders
    bad = audit_rows(spark, [("t", "n", 0.0, 1.0, "FAIL")])
    good = audit_rows(spark, [("t", "n", 0.0, 0.0, "PASS")])

    def catch_up():
        alerts.start_alerts(alerts.summary_stream(spark, published), sent, progress).awaitTermination()
        return sorted(r.run_id for r in spark.read.parquet(sent).collect())

    alerts.publish_summary(runs.summarise(bad, "first", "agency"), published)
    alerts.publish_summary(runs.summarise(good, "second", "agency"), published)
    assert catch_up() == ["first"]
    alerts.publish_summary(runs.summarise_error(spark, "boom", "third", "agency"), published)
    assert catch_up() == ["first", "third"]
    assert catch_up() == ["first", "third"]


def test_a_summary_published_twice_alerts_once(spark, stream_folders):
    published, sent, progress = stream_folders
    payload = runs.summarise(audit_rows(spark, [("t", "n", 0.0, 1.0, "FAIL")]), "run", "agency")

    def catch_up(remembered="1 day"):
        query = alerts.start_alerts(alerts.summary_stream(spark, published), sent, progress, remembered)
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"], spark.read.parquet(sent).count()

    for _ in range(2):  # twice in one batch, then in a later one
        alerts.publish_summary(payload, published)
    assert catch_up()[1] == 1
    alerts.publish_summary(payload, published)
    assert catch_up() == (1, 1)


def test_old_runs_are_forgotten(spark, stream_folders):
    published, sent, progress = stream_folders
    for run in ("a", "b", "c"):
        alerts.publish_summary(runs.summarise_error(spark, "boom", run, "agency"), published)
        query = alerts.start_alerts(alerts.summary_stream(spark, published), sent, progress, "0 seconds")
        query.awaitTermination()
        time.sleep(0.2)
    assert sorted(r.run_id for r in spark.read.parquet(sent).collect()) == ["a", "b", "c"]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 3
