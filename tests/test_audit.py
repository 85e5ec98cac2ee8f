"""The check catalogue: golden audits, NULL rules and agreement of both compilers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from hirelattice.plans import audit, recruiting
from hirelattice.plans.checks import Check, MatchedTotal, Rows, Surplus, Total, Unmatched
from hirelattice.sources import tables
from hirelattice.sources.tables import create_namespace

from .conftest import day


def by_name(df):
    return {r.check_name: r for r in df.collect()}


def test_clean_data_passes_everything(clean):
    rows = by_name(recruiting.audit_checks(clean))
    assert len(rows) == 19
    assert {r.status for r in rows.values()} == {"PASS"}
    assert rows["revenue_total_vs_filled_vacancies"].expected == pytest.approx(7613.46)


def test_five_faults_trip_exactly_seven_checks(clean):
    rows = by_name(recruiting.audit_checks(recruiting.inject_faults(clean)))
    failing = {name: r.difference for name, r in rows.items() if r.status == "FAIL"}
    assert failing == {
        "orphan_vacancies_client": 1.0,  # c_003 is the rarest client
        "duplicate_placement_id": 1.0,
        "placements_vs_filled_vacancies": 1.0,
        "hired_applications_vs_placements": 1.0,
        "filled_vacancies_missing_close_date": 1.0,
        "negative_or_missing_marketing_spend": 3.0,
        "won_deals_without_client": 1.0,
    }


def test_fault_report_counts_touched_rows(clean):
    report = recruiting.injected_report(clean, recruiting.inject_faults(clean))
    assert [r.rows_affected for r in report.collect()] == [1, 1, 1, 3, 1]


def dirty(rows, frames_of):
    """Missing keys, repeated parents, missing dates and orphans in every table."""
    vacancies = rows["vacancies"] + [
        rows["vacancies"][0],  # repeated parent: matched fees must fan out
        (None, "c_999", "x", "Data", "mid", day("2025-01-01"), day("2024-01-01"), "filled", 1),
        (None, None, "x", "Data", "mid", day("2025-01-01"), day("2025-01-05"), "open", 1),
        ("v_0099", "c_999", "x", "Data", "mid", day("2025-01-01"), None, "filled", 1),
    ]
    applications = rows["applications"] + [
        (None, "v_0004", "cand_00004", day("2025-02-04"), "hired"),  # hired, but without id
        (None, "v_0004", "cand_00004", day("2025-02-04"), "hired"),
        ("app_000001", None, None, day("2025-02-04"), None),
        ("app_000020", "v_0001", "cand_77777", day("2025-02-04"), "nonsense"),
    ]
    placements = rows["placements"] + [
        ("p_0001", "v_0001", "cand_00001", None, 1, 100.0),
        (None, None, "cand_00001", day("2025-04-01"), 1, 50.5),
        ("p_0010", "v_0004", "cand_00004", day("2025-04-01"), 1, 25.0),
        ("p_0011", "v_5555", "cand_00004", day("2025-04-01"), 1, None),
    ]
    deals = rows["sales_deals"] + [("d_9", "x", "won", 1.0, day("2025-01-01"), None, None)]
    marketing = rows["marketing_daily"] + [
        (day("2025-01-03"), "Meta Ads", "x", None, 5, 9, 0), (day("2025-01-03"), "Meta Ads", "x", -1.0, None, 9, 0)
    ]
    return frames_of(
        rows, vacancies=vacancies, applications=applications, placements=placements,
        sales_deals=deals, marketing_daily=marketing,
    )


EXPECTED_DIRTY = {
    "orphan_vacancies_client": (0, 3),
    "orphan_applications_vacancy": (0, 1),
    "orphan_applications_candidate": (0, 2),
    "orphan_placements_vacancy": (0, 2),
    "duplicate_vacancy_id": (0, 3),
    "duplicate_application_id": (0, 3),
    "duplicate_placement_id": (0, 2),
    "placements_vs_filled_vacancies": (7, 8),
    "hired_applications_vs_placements": (6, 8),
    # p_0010 pairs with two hired rows that have no id; p_None and p_0011 with none
    "placements_without_hired_application": (0, 4),
    "revenue_total_vs_monthly_report": (7788.96, 7688.96),
    # v_0001 is there twice: its 2912.37 + 100 count double; v_0004 is not filled
    "revenue_total_vs_filled_vacancies": (7788.96, 10725.83),
    "filled_vacancies_missing_close_date": (0, 1),
    "open_vacancies_with_close_date": (0, 1),
    "closed_before_opened": (0, 1),
    "negative_or_missing_marketing_spend": (0, 2),
    "clicks_exceed_impressions": (0, 1),
    "won_deals_without_client": (0, 1),
    "closed_deals_without_close_date": (0, 1),
}


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, spark):
    """Small sides may be broadcast, or nothing may."""
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "10MB" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set(key, before)


@pytest.fixture
def on_disk(spark, tmp_path):
    """Frames as stored tables, whose size Spark knows."""

    def store(tables):
        for name, frame in tables.items():
            frame.write.parquet(str(tmp_path / name))
        return {name: spark.read.parquet(str(tmp_path / name)) for name in tables}

    return store


@pytest.mark.parametrize("compile_audit", [audit.audit_fused, audit.audit_by_branch])
def test_null_and_duplicate_rules(rows, frames_of, joins, on_disk, compile_audit):
    found = by_name(compile_audit(recruiting.CHECKS, on_disk(dirty(rows, frames_of))))
    assert {n: (r.expected, r.actual) for n, r in found.items()} == {
        n: (pytest.approx(e), pytest.approx(a)) for n, (e, a) in EXPECTED_DIRTY.items()
    }


@pytest.mark.parametrize("compile_audit", [audit.audit_fused, audit.audit_by_branch])
def test_empty_tables(rows, frames_of, joins, on_disk, compile_audit):
    empty = on_disk(frames_of(rows, **{name: [] for name in rows}))
    found = by_name(compile_audit(recruiting.CHECKS, empty))
    nulls = {n for n, r in found.items() if r.actual is None}
    assert nulls == {"revenue_total_vs_monthly_report", "revenue_total_vs_filled_vacancies"}
    for name, row in found.items():
        assert row.status == ("FAIL" if name in nulls else "PASS")
        if name not in nulls:
            assert row.actual == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fused_audit_shares_scans(clean, joins, on_disk):
    stored = on_disk(clean)
    fused = plan(recruiting.audit_checks(stored))
    branch = plan(audit.audit_by_branch(recruiting.CHECKS, stored))
    assert "Expand" not in fused and "Join" not in fused
    assert "LeftAnti" in branch
    assert branch.count("FileScan parquet") > 25
    assert fused.count("FileScan parquet") == 7


def test_keys_of_different_types_meet(spark):
    """Keys of a domain are compared as a join compares them: in their common type."""
    child = spark.createDataFrame([(1, 0.0, "2025-01-01 00:00:00"), (2, -0.0, "2025-06-01 00:00:00"), (9, 5.5, None)], "i int, f double, t string")
    child = child.select("i", "f", F.col("t").cast("timestamp").alias("t"), F.col("i").cast("string").cast("binary").alias("b"))
    parent = child.select(F.col("i").cast("bigint").alias("i"), (F.col("f") * 1).cast("float").alias("f"), "t", "b").where("i < 9")
    checks = [Check("t", c, "", Unmatched("child", (c,), "parent", (c,))) for c in "iftb"]
    for compile_audit in (audit.audit_fused, audit.audit_by_branch):
        found = {r.check_name: r.actual for r in compile_audit(checks, {"child": child, "parent": parent}).collect()}
        assert found == {"i": 1.0, "f": 1.0, "t": 1.0, "b": 1.0}


def test_tolerance_is_strict(spark):
    rows = [("t", str(d), "", 1.0, 1.0 + d) for d in (0.0, 0.004, 0.006, -0.004, -0.006)] + [("t", "n", "", None, 1.0)]
    frame = spark.createDataFrame(rows, "check_type string, check_name string, description string, expected double, actual double")
    found = {r.check_name: r.status for r in audit.score(frame).collect()}
    assert found == {"0.0": "PASS", "0.004": "PASS", "0.006": "FAIL", "-0.004": "PASS", "-0.006": "FAIL", "n": "FAIL"}


def test_large_totals_are_compared_to_the_cent(spark):
    """At 1e15 a DOUBLE sum is off by more than the tolerance; the exact total is not."""
    left = spark.range(200_000).select((F.lit(9_000_000_000.0) + F.col("id") / 100).alias("amount"))
    right = left.orderBy(F.desc("amount"))
    short = left.where("amount <> 9000000000.01")
    checks = [
        Check("t", "same", "", Total("right", "amount"), Total("left", "amount")),
        Check("t", "short", "", Total("short", "amount"), Total("left", "amount")),
    ]
    found = by_name(audit.audit_fused(checks, {"left": left, "right": right, "short": short}))
    assert found["same"].status == "PASS"
    assert found["short"].difference == -9000000000.01


def test_gate(clean, rows, frames_of):
    recruiting.integrity_gate(clean)
    lost = frames_of(rows, candidates=rows["candidates"][1:])
    with pytest.raises(audit.IntegrityError, match="orphan_placements_candidate: expected 0.0, got 1.0"):
        recruiting.integrity_gate(lost)
    assert len(recruiting.GATE) == 9


def test_hot_and_missing_keys_stay_small_in_the_shuffle(spark, joins, on_disk):
    """A third of the rows on one key and a third without: the counts are still whole."""
    child = spark.range(90_000).select(
        F.when(F.col("id") < 30_000, F.lit(7)).when(F.col("id") < 60_000, F.lit(None)).otherwise(F.col("id")).alias("k"),
        F.lit(1.25).alias("amount"),
    )
    parent = spark.range(0, 75_000).select(F.col("id").alias("k"))
    checks = [
        Check("t", "orphans", "", Unmatched("child", ("k",), "parent", ("k",))),
        Check("t", "surplus", "", Surplus("child", "k")),
        Check("t", "matched", "", MatchedTotal("child", "amount", ("k",), "parent", ("k",))),
        Check("t", "rows", "", Rows("child")),
    ]
    tables = on_disk({"child": child, "parent": parent})
    for compile_audit in (audit.audit_fused, audit.audit_by_branch):
        found = {r.check_name: r.actual for r in compile_audit(checks, tables).collect()}
        assert found == {"orphans": 45_000.0, "surplus": 59_999.0 , "matched": 56_250.0, "rows": 90_000.0}


def test_dates_survive(clean):
    assert clean["vacancies"].first().opened_at == date(2025, 1, 10)


def test_kept_counters(spark, clean, frames_of, rows):
    """Stored, replaced and appended counters give the audit of the tables as they are, without a shuffle of keys."""
    create_namespace(spark, "kept_counters")
    stored = "kept_counters.c"
    statuses = lambda df: {r.check_name: (r.expected, r.actual, r.status) for r in df.collect()}
    faulty = recruiting.inject_faults(clean)
    audit.store_counters(recruiting.CHECKS, clean, stored, buckets=4)
    kept = audit.audit_stored(recruiting.CHECKS, spark.table(stored))
    text = plan(kept)
    assert text.count("Exchange") == 1 and "Exchange SinglePartition" in text and text.count("FileScan") == 1
    assert statuses(kept) == statuses(recruiting.audit_checks(clean))
    for source in ("clients", "vacancies", "placements", "marketing_daily", "sales_deals"):
        audit.store_counters(recruiting.CHECKS, faulty, stored, buckets=4, only=[source])
    assert statuses(audit.audit_stored(recruiting.CHECKS, spark.table(stored))) == statuses(recruiting.audit_checks(faulty))
    more = frames_of(rows, applications=rows["applications"][:2])
    audit.store_counters(recruiting.CHECKS, more, stored, buckets=4, only=["applications"], appended=True)
    grown = {**faulty, "applications": clean["applications"].union(more["applications"])}
    assert statuses(audit.audit_stored(recruiting.CHECKS, spark.table(stored))) == statuses(recruiting.audit_checks(grown))


def test_kept_counters_take_more_buckets_for_more_keys(spark, clean, monkeypatch):
    """A bucket's keys are added up in one task, so their number must not grow with the tables."""
    create_namespace(spark, "kept_buckets")
    monkeypatch.setattr(audit, "ROWS_A_BUCKET", 5)
    faulty = recruiting.inject_faults(clean)
    audit.store_counters(recruiting.CHECKS, clean, "kept_buckets.c", buckets=2)
    buckets = tables.bucket_count(spark, "kept_buckets.c")
    assert buckets > 8
    changed = ["clients", "vacancies", "placements", "marketing_daily", "sales_deals"]
    audit.store_counters(recruiting.CHECKS, faulty, "kept_buckets.c", buckets=2, only=changed)
    assert tables.bucket_count(spark, "kept_buckets.c") == buckets
    kept = audit.audit_stored(recruiting.CHECKS, spark.table("kept_buckets.c"))
    assert plan(kept).count("Exchange") == 1
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, recruiting.audit_checks(faulty).collect()))
    assert tables.bucket_count(spark, "kept_buckets.missing") is None
