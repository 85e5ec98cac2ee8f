"""Reports and ids over tables that grow."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from hirelattice.operators.metrics import latest_rows, period_totals
from hirelattice.plans import growing
from hirelattice.schemas import RUN_LOG
from hirelattice.sources import tables

from .conftest import collected

NAMES = {"month": "m", "counted": "n", "total": "t", "mean": "a"}


@pytest.fixture
def kept(spark, request):
    namespace = tables.create_namespace(spark, f"grow_{abs(hash(request.node.name))}")
    return growing.MonthlyTotals(spark, f"{namespace}.facts", f"{namespace}.states", "day", "amount")


def facts(spark, rows):
    return spark.createDataFrame([(date(2025, m, d) if m else None, a) for m, d, a in rows], "day date, amount double")


def full(df):
    return collected(period_totals(df.select("day", "amount"), "day", "amount", **NAMES))


def test_states_equal_the_full_report_after_every_step(spark, kept):
    odd = [(1, 5, 10.25), (1, 6, None), (2, 1, 1e15), (2, 2, 0.00001), (None, 0, 3.5), (3, 1, -2.0)]
    kept.build(facts(spark, odd))
    assert collected(kept.report(**NAMES)) == full(facts(spark, odd))
    more = [(2, 9, 4.0), (4, 1, 8.0), (None, 0, None)]
    kept.append(facts(spark, more))
    assert collected(kept.report(**NAMES)) == full(facts(spark, odd + more))
    kept.replace_months(facts(spark, [(1, 7, 99.0), (None, 0, 1.0)]))
    left = [r for r in odd + more if r[0] not in (1, None)] + [(1, 7, 99.0), (None, 0, 1.0)]
    assert collected(kept.report(**NAMES)) == full(facts(spark, left))
    assert sorted(map(repr, collected(spark.table(kept.table).select("day", "amount")))) == sorted(map(repr, collected(facts(spark, left))))
    kept.append(facts(spark, []))
    assert collected(kept.report(**NAMES)) == full(facts(spark, left))


def test_a_refresh_reads_only_its_months(spark, kept):
    kept.build(facts(spark, [(m, 1, float(m)) for m in range(1, 13)]))
    read = kept.stored([date(2025, 3, 1)])
    assert len(read.inputFiles()) == 1
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "2025-03-01" in text[text.index("PartitionFilters"):]
    assert [r.amount for r in read.collect()] == [3.0]
    kept.refresh(read)  # again: nothing changes
    assert collected(kept.report(**NAMES)) == full(facts(spark, [(m, 1, float(m)) for m in range(1, 13)]))


def test_states_merge_in_any_grouping(spark):
    rows = facts(spark, [(m % 3 + 1, m % 28 + 1, m / 7 if m % 5 else m / 4) for m in range(200)]).withColumn("month", F.trunc("day", "MONTH"))
    parts = [growing.month_states(rows.where(F.pmod(F.hash("day"), F.lit(3)) == k), "month", "amount") for k in range(3)]
    whole = growing.totals_from_states(growing.merged(parts[0].union(parts[1]).union(parts[2])), **NAMES)
    assert collected(whole) == full(rows)


def test_ids_hold_when_a_table_grows(spark):
    tables.create_namespace(spark, "numbered")
    table = "numbered.t"

    def append(batch, *keys):
        growing.append_numbered(spark.createDataFrame([(k,) for k in keys], "k string"), table, ["k"], "id", "x_", 2, batch)
        return sorted(collected(spark.table(table).select("id", "k")))

    first = append("one", "b", "a", "a")
    assert first == [("x_01", "a"), ("x_02", "a"), ("x_03", "b")]
    assert append("one", "b", "a", "a") == first
    second = append("two", "a")
    assert second == [*first, ("x_04", "a")]
    tables.replace_table(spark.table(table).where("id <> 'x_04'"), table)  # the newest goes; its number does not come back
    assert append("three", "z") == [*first, ("x_05", "z")]
    assert append("none") == [*first, ("x_05", "z")]
    assert append("many", *(f"k{i:03d}" for i in range(100)))[-1] == ("x_99", "k093")
    assert ("x_105", "k099") in collected(spark.table(table).select("id", "k"))


def test_newest_rows_read_the_newest_days_only(spark):
    tables.create_namespace(spark, "by_day")
    rows = [
        (f"r{d:02d}{i}", "validation", datetime(2025, 1, d, i, tzinfo=timezone.utc), None, "success", 19, 0, None)
        for d in range(1, 11) for i in range(4)
    ]
    log = spark.createDataFrame(rows, RUN_LOG).withColumn("run_day", F.to_date("started_at"))
    tables.replace_table(log, "by_day.runs", ["run_day"])
    stored = spark.table("by_day.runs")
    newest = growing.newest_rows(stored, "run_day", "started_at", "run_id", ["run_id"], 6)
    assert collected(newest) == collected(latest_rows(log, "started_at", "run_id", ["run_id"], 6))
    text = newest._jdf.queryExecution().executedPlan().toString()
    assert "2025-01-10" in text and "2025-01-09" in text and "2025-01-08" not in text
    assert growing.newest_rows(stored, "run_day", "started_at", "run_id", ["run_id"], 500).count() == 40
    assert growing.newest_rows(stored.where("false"), "run_day", "started_at", "run_id", ["run_id"], 5).count() == 0
