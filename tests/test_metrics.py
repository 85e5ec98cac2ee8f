"""Reports on the small agency: values, NULL groups, ties, order."""

import pytest
from pyspark.sql import functions as F

from hirelattice.operators import matching, metrics
from hirelattice.plans import recruiting

from .conftest import collected, day


def test_time_to_fill(clean, rows, frames_of):
    assert collected(recruiting.time_to_fill_by_department(clean["vacancies"])) == [
        ("Sales", 1, 43.0), ("Finance", 1, 21.0), ("Data", 2, 20.5)
    ]
    undated = rows["vacancies"] + [("v_9", "c_001", "x", "Data", "mid", day("2025-01-01"), None, "filled", 1)]
    out = recruiting.time_to_fill_by_department(frames_of(rows, vacancies=undated)["vacancies"])
    assert ("Data", 3, 20.5) in collected(out)  # counted, but not averaged


def test_fill_rate(clean):
    assert collected(recruiting.fill_rate_by_open_month(clean["vacancies"])) == [
        (day("2025-01-01"), 2, 2, 100.0), (day("2025-02-01"), 3, 1, 33.3), (day("2025-03-01"), 1, 1, 100.0)
    ]


def test_funnel_ignores_unknown_stages(clean, rows, frames_of):
    assert collected(recruiting.hiring_funnel(clean["applications"])) == [(9, 7, 6, 5, 4)]
    odd = rows["applications"] + [("a", "v", "c", None, "nonsense"), ("b", "v", "c", None, None)]
    out = recruiting.hiring_funnel(frames_of(rows, applications=odd)["applications"])
    assert collected(out) == [(11, 7, 6, 5, 4)]


def test_hire_rate_joins_like_a_plain_join(clean, rows, frames_of):
    out = collected(recruiting.hire_rate_by_channel(clean["applications"], clean["candidates"]))
    assert out == [
        ("LinkedIn Ads", 5, 3, 60.0), ("Referral", 2, 1, 50.0), ("Google Ads", 1, 0, 0.0), ("Outbound", 1, 0, 0.0)
    ]
    twice = frames_of(
        rows,
        candidates=rows["candidates"] + [rows["candidates"][0], (None, "x", "Referral", None)],
        applications=rows["applications"] + [("a", "v", None, None, "hired"), ("b", "v", "cand_x", None, "hired")],
    )
    plain = (
        twice["applications"].join(twice["candidates"], "candidate_id").groupBy("source_channel")
        .agg(F.count("*").alias("n"), F.count_if(F.col("furthest_stage") == "hired").alias("h"))
    )
    out = recruiting.hire_rate_by_channel(twice["applications"], twice["candidates"])
    assert {(r[0], r[1], r[2]) for r in out.collect()} == {tuple(r) for r in plain.collect()}


def test_cost_per_hire(clean, rows, frames_of):
    out = collected(recruiting.cost_per_hire_by_channel(clean["applications"], clean["candidates"], clean["marketing_daily"]))
    # no spend: NULL and first; spend without hires (Google, Meta): gone
    assert out == [("Referral", 1, None, None), ("LinkedIn Ads", 3, 85.05, 28.35)]
    # the unrounded spend is divided: 0.01 * 2 / 3 is not 0.02 / 3 of a rounded part
    fine = [(day("2025-01-01"), "LinkedIn Ads", "x", 0.014, 1, 1, 1), (day("2025-01-02"), "LinkedIn Ads", "x", 0.004, 1, 1, 1)]
    tables = frames_of(rows, marketing_daily=fine)
    out = recruiting.cost_per_hire_by_channel(tables["applications"], tables["candidates"], tables["marketing_daily"])
    assert collected(out)[1] == ("LinkedIn Ads", 3, 0.02, 0.01)


def test_monthly_revenue_has_a_group_without_month(rows, frames_of):
    undated = rows["placements"] + [("p_9", "v", "c", None, 1, 10.5), ("p_10", "v", "c", None, 1, None)]
    assert collected(recruiting.monthly_revenue(frames_of(rows, placements=undated)["placements"])) == [
        (None, 2, 10.5, 10.5), (day("2025-02-01"), 2, 4913.47, 2456.74), (day("2025-03-01"), 2, 2699.99, 1350.0)
    ]


def test_deals(clean, rows, frames_of):
    assert collected(recruiting.deals_by_stage(clean["sales_deals"])) == [
        ("won", 2, 5500.75), ("lost", 1, 1200.0), ("open", 1, 900.0)
    ]
    assert collected(recruiting.win_rate(clean["sales_deals"])) == [(2, 1, 66.7)]
    only_open = frames_of(rows, sales_deals=[rows["sales_deals"][3]])["sales_deals"]
    assert collected(recruiting.win_rate(only_open)) == [(0, 0, None)]


def test_reports_on_empty_tables(rows, frames_of):
    empty = frames_of(rows, **{name: [] for name in rows})
    assert collected(recruiting.hiring_funnel(empty["applications"])) == [(0, 0, 0, 0, 0)]
    assert collected(recruiting.time_to_fill_by_department(empty["vacancies"])) == []
    assert collected(recruiting.win_rate(empty["sales_deals"])) == [(0, 0, None)]


def test_rarest_value_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    assert collected(metrics.rarest_value(df, "k")) == [("a", 1)]


def test_every_row(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    check = lambda frame: metrics.every_row(frame, F.col("x") > 0, "holds").first()[0]
    assert check(df.where("x = 1")) is True
    assert check(df) is False
    assert check(df.where("false")) is True


def test_orphans_and_members(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4), (3, 5)], "k int, id int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    orphans = matching.orphan_rows(child, parent, ["k"], ["p"])
    assert sorted(r.id for r in orphans.collect()) == [3, 4, 5]
    assert sorted(r.id for r in matching.member_rows(child, parent, ["k"], ["p"]).collect()) == [1, 2]
    assert matching.orphan_count(child, parent, ["k"], ["p"]).first()[0] == 3
    assert matching.all_members(child, parent, ["k"], ["p"]).first()[0] is False
    assert matching.all_members(child.where("k = 1"), parent, ["k"], ["p"]).first()[0] is True
    assert matching.all_members(child.where("false"), parent, ["k"], ["p"]).first()[0] is True
    assert "LeftAnti" in orphans._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_hot_join_key(spark, tmp_path, threshold):
    """A third of the facts on one key: counted before a shuffled join, or joined in place; the same counts either way."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        facts = spark.range(30_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"),
            (F.col("id") % 2 == 0).alias("hit"),
        )
        dim = spark.range(30_000).select(F.col("id").alias("d"), (F.col("id") % 4).cast("string").alias("g"))
        dim.union(dim.limit(10)).write.parquet(str(tmp_path / "dim"))
        dim = spark.read.parquet(str(tmp_path / "dim"))
        out = metrics.rate_by_lookup(facts, "k", dim, "d", "g", F.col("hit"), total="n", hits="h", rate="r", digits=2)
        plain = facts.join(dim, F.col("k") == F.col("d")).groupBy("g").agg(
            F.count("*").alias("n"), F.count_if("hit").alias("h")
        )
        assert {(r.g, r.n, r.h) for r in out.collect()} == {(r.g, r.n, r.h) for r in plain.collect()}
        text = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("Aggregate" in text[text.index("Join Inner"):]) == (threshold == "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n", [3, 20])
def test_latest_rows_breaks_ties(spark, n):
    df = spark.createDataFrame([(f"r{i:02d}", i // 10) for i in range(25)], "run_id string, started_at int")
    out = metrics.latest_rows(df, "started_at", "run_id", ["run_id"], n)
    assert [r[0] for r in out.collect()] == [f"r{i:02d}" for i in range(24, 24 - n, -1)]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("children", [0, 3, 5000])
def test_orphans_against_a_large_parent(spark, tmp_path, children):
    """The same counts as without the filter, and far fewer parent rows behind it."""
    child = spark.range(children).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") * 3).alias("k"), F.col("id").cast("string").alias("s")
    )
    parent = spark.range(40_000).select((F.col("id") * 2).alias("p"), F.col("id").cast("string").alias("s"))
    for keys, parents in ((["k"], ["p"]), (["k", "s"], ["p", "s"])):
        plain = collected(matching.orphan_count(child, parent, keys, parents))
        assert collected(matching.orphan_count_of_few(child, parent, keys, parents)) == plain
    keyed = child.where("k IS NOT NULL").select("k")
    passed = matching.likely_members(parent.select(F.col("p").alias("k")), ["k"], matching.key_filter(keyed, ["k"], 1 << 17), 1 << 17)
    held = passed.select("k").distinct()
    assert keyed.join(parent, F.col("k") == F.col("p"), "left_semi").join(held, "k", "left_anti").count() == 0
    assert passed.count() < 40_000 * 0.1 + children
