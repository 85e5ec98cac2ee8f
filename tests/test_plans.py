"""Physical plans: pruning, pushdown, skew splitting, no unsized broadcast, no Python."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hirelattice.plans import audit, recruiting, star


@pytest.fixture(scope="module")
def stored(spark, clean, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    for name, frame in clean.items():
        frame.write.parquet(str(folder / name))
    return {name: spark.read.parquet(str(folder / name)) for name in clean}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session values for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before[key] = spark.conf.get(key)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


def test_scans_read_only_what_the_report_needs(stored):
    text = plan(recruiting.time_to_fill_by_department(stored["vacancies"]))
    assert "ReadSchema: struct<department:string,opened_at:date,closed_at:date,status:string>" in text
    assert "EqualTo(status,filled)" in text
    text = plan(recruiting.cost_per_hire_by_channel(*(stored[n] for n in ("applications", "candidates", "marketing_daily"))))
    assert "EqualTo(furthest_stage,hired)" in text
    assert "ReadSchema: struct<channel:string,spend_usd:double>" in text


def test_counts_come_from_one_scan_and_one_exchange(stored):
    for report in (recruiting.hiring_funnel(stored["applications"]), recruiting.win_rate(stored["sales_deals"])):
        text = plan(report)
        assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_audit_leaves_out_rows_that_cannot_count(stored):
    hired_only = [c for c in recruiting.CHECKS if c.check_name == "placements_without_hired_application"]
    text = plan(audit.audit_fused(hired_only, stored))
    assert "EqualTo(furthest_stage,hired)" in text


def test_no_query_runs_python_or_a_product_join(stored):
    for df in [
        audit.audit_fused([*recruiting.CHECKS, recruiting.PLACED_CANDIDATES], stored),
        recruiting.hire_rate_by_channel(stored["applications"], stored["candidates"]),
        recruiting.inject_faults(stored)["clients"],
    ]:
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_grouped_reports_aggregate_before_the_shuffle(stored):
    text = plan(recruiting.monthly_revenue(stored["placements"]))
    exchange = text.index("Exchange hashpartitioning")
    assert "partial_sum" in text[exchange:]


def test_a_hot_order_is_split_and_nothing_is_lost(spark, settings, tmp_path):
    """A third of the line items sit on one order: its join partition is read in pieces."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="40KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    lines = spark.range(120_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit(11)).otherwise(F.col("id") % 4000).alias("l_orderkey"),
        F.timestamp_add("DAY", F.col("id") % 400, F.lit("1996-01-01").cast("timestamp_ntz")).alias("l_shipdate"),
    )
    orders = spark.range(4000).select(
        F.col("id").alias("o_orderkey"),
        F.lit("1996-02-01").cast("timestamp_ntz").alias("o_orderdate"),
        (F.col("id") % 5).cast("string").alias("o_orderpriority"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    report = star.days_to_ship_by_priority(star.read_tables(spark, str(tmp_path)))
    rows = report.collect()
    assert sum(r.shipped_lines for r in rows) == lines.where("l_shipdate >= timestamp_ntz'1996-02-01'").count()
    assert "skew=true" in plan(report)


def test_only_bounded_frames_are_broadcast(stored, settings):
    """With automatic broadcasts off, what is still broadcast is a row limit or one row per partition."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    for report in (
        audit.audit_fused(recruiting.CHECKS, stored),
        recruiting.hire_rate_by_channel(stored["applications"], stored["candidates"]),
        recruiting.cost_per_hire_by_channel(*(stored[n] for n in ("applications", "candidates", "marketing_daily"))),
    ):
        assert "BroadcastExchange" not in plan(report)
    for name in ("clients", "vacancies", "marketing_daily", "sales_deals"):
        text = plan(recruiting.inject_faults(stored)[name])
        for side in re.split("BroadcastExchange", text)[1:]:
            assert "TakeOrderedAndProject" in side


def test_audit_reads_a_table_once_and_shuffles_by_key_once(stored):
    text = plan(audit.audit_fused(recruiting.CHECKS, stored))
    assert text.count("FileScan") == 7
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Exchange") == 2
    assert "partial_sum" in text[text.index("Exchange hashpartitioning"):]
