"""Odd values, sizes and session settings that must not change or lose results."""

import math
import time

import pytest
from pyspark.sql import functions as F

from hirelattice import functions as fn
from hirelattice import session
from hirelattice.operators import faults, shaping
from hirelattice.plans import audit, recruiting, runs
from hirelattice.plans.checks import VALIDITY, Check, Rows, Total
from hirelattice.schemas import PAYLOAD
from hirelattice.sources import csv_files, tables

from .conftest import collected, day


def total(spark, *amounts):
    return spark.createDataFrame([(float(a),) for a in amounts], "x double").agg(fn.exact_total("x")).first()[0]


def test_the_largest_exact_amount_is_exact(spark):
    assert total(spark, 1125581585.12, 1e10) == 11125581585.12


def test_small_amounts_add_up(spark):
    assert math.isclose(spark.range(1_000_000).select(F.lit(0.00004).alias("x")).agg(fn.exact_total("x")).first()[0], 40.0)


def test_large_and_odd_amounts(spark):
    assert total(spark, 1e15, 0.25) == 1e15 + 0.25
    assert total(spark, 1e300, 1.0) == 1e300
    assert math.isnan(total(spark, float("nan"), 1.0))
    assert total(spark, float("inf"), 1.0) == float("inf")
    assert total(spark, *[0.1] * 10) == 1.0


def test_an_odd_amount_fails_only_its_own_check(spark):
    frames = {"t": spark.createDataFrame([(1.0,), (float("nan"),)], "x double")}
    checks = [
        Check(VALIDITY, "total", "", Total("t", "x"), expected=Total("t", "x")),
        Check(VALIDITY, "rows", "", Rows("t"), expected=Rows("t")),
    ]
    for build in (audit.audit_fused, audit.audit_by_branch):
        assert {r.check_name: r.status for r in build(checks, frames).collect()} == {"total": "FAIL", "rows": "PASS"}


def test_a_failed_replacement_keeps_the_old_rows(spark):
    tables.create_namespace(spark, "kept")
    tables.replace_table(spark.range(5), "kept.t")
    broken = spark.range(5).select(F.when(F.col("id") > 2, F.raise_error(F.lit("no"))).otherwise("x").alias("s"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, "kept.t")
    assert spark.table("kept.t").count() == 5
    names = sorted(t.name for t in spark.catalog.listTables("kept"))
    assert len(names) == 2 and names[0] == "t" and names[1].startswith("t__v_")  # the pointer and its version
    assert tables.replace_table(spark.range(2).select(F.lit("y").alias("s")), "kept.t") == 2
    assert collected(spark.table("kept.t")) == [("y",)] * 2


def test_numbers_beyond_the_padding_keep_their_order(spark):
    filled = spark.createDataFrame([(n, f"v_{n}") for n in (9_999, 10_000, 100_000)], "vacancy_no long, vacancy_id string")
    chosen = spark.createDataFrame([(n, "c") for n in (9_999, 10_000, 100_000)], "vacancy_no long, candidate_id string")
    columns = {c: F.col(c) for c in ("vacancy_no", "vacancy_id", "candidate_id")}
    placed = shaping.placements_from(filled, chosen, "vacancy_no", columns, "placement_id", "p_", 4)
    assert [r.vacancy_no for r in placed.orderBy("placement_id").collect()] == [9_999, 10_000, 100_000]
    rows = spark.createDataFrame([(1, 1_000_000, "b"), (1, 999_999, "a")], "vacancy_no long, application_no long, candidate_id string")
    assert shaping.one_per_key(rows, "vacancy_no", "application_no", ["candidate_id"]).first().candidate_id == "a"
    ids = spark.createDataFrame([("p_10000", 1), ("p_9999", 2)], "id string, x long")
    assert [r.x for r in faults.duplicate_first(ids, "id").collect()].count(2) == 2


def test_faults_hit_as_many_rows_as_stated(spark):
    rows = spark.createDataFrame([("a", 1.0)] * 4 + [("a", 2.0), (None, 5.0)], "k string, x double")
    got = sorted(r.x for r in faults.negate_first(rows.where("k = 'a'"), ["k"], "x", 3).collect())
    assert got == [-1.0, -1.0, -1.0, 1.0, 2.0]
    cleared = faults.clear_on_first(rows, "k", F.col("k") == "a", "x")
    assert sum(r.x is None for r in cleared.collect()) == 1 and cleared.count() == 6


@pytest.mark.parametrize(("zone", "ansi"), [("Asia/Tokyo", "true"), ("UTC", "false"), ("America/Lima", "false")])
def test_session_settings_decide_nothing(spark, zone, ansi):
    late = spark.sql("SELECT timestamp'2025-03-01 23:30:00+00:00' AS t, timestamp_ntz'2025-03-01 23:30:00' AS n").collect()
    assert late
    before = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        frame = spark.sql("SELECT timestamp'2025-03-01 23:30:00+00:00' AS t, timestamp_ntz'2025-03-01 23:30:00' AS n, date'2025-03-01' AS d")
        assert collected(frame.select(*(fn.calendar_day(c) for c in "tnd"))) == [(day("2025-03-01"),) * 3]
        with pytest.raises(Exception, match="2025-13-77"):
            spark.sql("SELECT '2025-13-77' AS x").select(fn.parse_day("x")).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_malformed_csv_raises_without_ansi(spark, clean, tmp_path):
    (tmp_path / "placements.csv").write_text(
        "placement_id,vacancy_id,candidate_id,placed_at,monthly_salary_usd,placement_fee_usd\np,v,c,2025-01-01,many,1.0\n"
    )
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="many"):
            csv_files.read_csv(spark, str(tmp_path / "placements.csv"), clean["placements"].schema).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_csv_keeps_blanks_and_refuses_line_breaks(spark, tmp_path):
    frame = spark.createDataFrame([("  lead", 1), ("trail  ", 2), ("two\nlines", 3)], "s string, n long")
    with pytest.raises(Exception, match="line break"):
        csv_files.write_csv(frame, str(tmp_path), "broken")
    path = csv_files.write_csv(frame.where("n < 3"), str(tmp_path), "blanks")
    assert sorted(collected(csv_files.read_csv(spark, path, frame.schema))) == [("  lead", 1), ("trail  ", 2)]
    path = csv_files.write_csv(frame, str(tmp_path), "lines", multiline=True)
    assert ("two\nlines", 3) in collected(csv_files.read_csv(spark, path, frame.schema, multiline=True))


def test_console_numbers_and_missing_parts(spark):
    failures = [("validity", "big", "", 1e16, 0.00005, "FAIL"), ("validity", None, None, 1.0, 2.0, "FAIL"), ("error", "e", None, None, None, "FAIL")]
    payload = spark.createDataFrame([("s", "p", "r", "failed_checks", 3, 3, 0, failures)], PAYLOAD)
    assert [r.message for r in runs.console_lines(payload).collect()] == [
        "  FAIL big: expected 1e+16, got 5e-05", "  FAIL null: expected 1.0, got 2.0", "  ERROR null",
    ]
    assert runs.alert_message(payload).first().message.count("•") == 3


def test_the_cause_of_a_broken_run_is_kept(spark):
    tables.create_namespace(spark, "broken_cause")

    def build():
        raise ValueError("x" * 900)

    outcome = runs.run_validation(spark, build, audit_table="broken_cause.a", run_log="broken_cause.r", project="p")
    assert len(str(outcome.cause)) == 900 and len(outcome.record.first().error_message) == 500


def test_the_gate_stops_a_write(spark, clean):
    tables.create_namespace(spark, "gated")
    assert recruiting.write_if_sound({**clean, "clients": clean["clients"].limit(0)}, "gated") == 0
    assert spark.catalog.listTables("gated") == []


def test_long_ids_give_their_whole_number(spark):
    frame = spark.createDataFrame([("p_" + "0" * 60 + "7",)], "x string")
    assert frame.select(fn.trailing_number("x", "p_")).first()[0] == 7


def test_written_results_leave_no_shuffle_files(spark):
    """Stages of a long run do not pile up the shuffles of those before them."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        named = blocks.getAllBlocks().mkString(" ").split()
        return {n for n in named if n.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(session.SHUFFLE_CLEANUP)
    kept = session.materialise(spark.range(100_000).groupBy((F.col("id") % 5000).alias("k")).count(), "shuffled")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert kept.count() == 5000 and spark.conf.get(session.SHUFFLE_CLEANUP) == setting


def test_tasks_are_bounded_unless_the_session_says_otherwise(spark):
    scan, shuffle = (key for key, *_ in session.TASK_BYTES)
    before = {key: spark.conf.get(key) for key in (scan, shuffle)}
    try:
        spark.conf.unset(scan)
        spark.conf.set(shuffle, "3m")
        session.bound_tasks(spark)
        assert spark.conf.get(scan) == f"{8 << 20}b" and spark.conf.get(shuffle) in ("3m", f"{3 << 20}b")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
