"""Ids, calendars, censoring, placements, faults."""

from pyspark.sql import functions as F

from hirelattice.operators import faults, shaping

from .conftest import collected, day


def test_sequential_ids_follow_the_order_across_partitions(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("k"), F.lit("x").alias("v")).repartition(7)
    out = shaping.sequential_ids(df, ["k"], "id", "app_", 6)
    assert out.columns == ["id", "k", "v"]
    assert sorted(collected(out)) == [(f"app_{i + 1:06d}", i, "x") for i in range(1000)]


def test_copies_are_numbered_and_spread(spark, monkeypatch):
    """A third of the rows are copies of one row: every copy gets its own number and id."""
    monkeypatch.setattr(shaping, "_COPY_CHUNK", 50)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id")).alias("k"), F.lit(None).cast("string").alias("v")
    )
    numbered = shaping.number_copies(df, "n")
    assert numbered.count() == 3000
    assert sorted(r.n for r in numbered.where("k = 500").collect()) == list(range(1, 1002))
    ids = shaping.sequential_ids(df, ["k"], "id", "x_", 4)
    assert [r.id for r in ids.orderBy("id").collect()] == [f"x_{i + 1:04d}" for i in range(3000)]
    assert [r.k for r in ids.orderBy("id").collect()] == sorted(r.k for r in df.collect())


def test_ties_are_broken_by_the_other_columns(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 0)], "k string, v int").repartition(3)
    out = collected(shaping.sequential_ids(df, ["k"], "id", "x_", 1))
    assert sorted(out) == [("x_1", "a", 1), ("x_2", "a", 2), ("x_3", "b", 0)]


def test_sequential_ids_of_nothing(spark):
    assert shaping.sequential_ids(spark.range(0), ["id"], "n", "p_", 4).count() == 0


def test_first_seen_and_attributes(clean, spark):
    seen = shaping.first_seen(clean["applications"], "candidate_id", "applied_at", "created_at")
    pool = spark.createDataFrame([(i, f"country {i}") for i in range(4)], "number int, country string")
    number = F.substring("candidate_id", 6, 20).cast("int") - 1
    out = shaping.attach_by_number(seen, number, pool, "number")
    assert sorted(collected(out))[0] == ("cand_00001", day("2025-01-11"), "country 0")
    assert sorted(collected(out))[4] == ("cand_00005", day("2025-02-06"), None)


def test_calendar_spine(spark):
    channels = spark.createDataFrame([("a", 1), ("b", 2)], "channel string, base int")
    out = shaping.calendar_spine(channels, F.lit("2025-01-30").cast("date"), F.lit("2025-02-02").cast("date"), "date")
    assert out.columns == ["date", "channel", "base"]
    assert out.count() == 8
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_marked_rows_come_in_order(spark):
    """Marking neither joins nor needs a second sort: ids follow the keys over all partitions; missing keys are equal."""
    rows = [(i % 40 if i % 9 else None, f"v{i % 7}" if i % 5 else None, "new") for i in range(400)]
    df = spark.createDataFrame(rows, "k bigint, v string, stage string").repartition(5)
    chosen = spark.createDataFrame([(3, "v1"), (None, None), (None, "v3"), (3, "v1"), (99, "v0")], "k bigint, v string")
    marked = shaping.mark_chosen(df, chosen, ["k", "v"], "stage", "taken")
    assert "Join" not in marked._jdf.queryExecution().optimizedPlan().toString()
    ids = shaping.sequential_ids(marked, ["k", "v"], "id", "x_", 3, ordered=True)
    assert ids.columns == ["id", "k", "v", "stage"]
    place = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    taken = {(3, "v1"), (None, None), (None, "v3")}
    expected = [(k, v, "taken" if (k, v) in taken else "new") for k, v, _ in sorted(rows, key=place)]
    assert [(r.k, r.v, r.stage) for r in ids.orderBy("id").collect()] == expected
    assert [r.id for r in ids.orderBy("id").collect()] == [f"x_{i + 1:03d}" for i in range(400)]


def test_the_kept_part_of_an_order_is_held_once(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, None, "c"), (1, 5, "a"), (2, None, None), (None, 1, "x")], "k int, v int, w string")
    ordered = df.withColumn("o", F.struct("v", "w"))
    best = shaping.one_per_key(ordered, "k", "o", ["v", "w"])
    assert "min_by" not in best._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(collected(best)) == [(1, None, "c"), (2, None, None)]


def test_censoring(spark):
    rows = [("filled", day("2025-01-01")), ("filled", day("2025-03-01")), ("open", None)]
    df = spark.createDataFrame(rows, "status string, closed date")
    out = shaping.censor_after(df, "status", "closed", F.lit("2025-02-01").cast("date"), "open")
    assert collected(out) == [("filled", day("2025-01-01")), ("open", None), ("open", None)]


def test_mark_and_place(clean):
    applications = clean["applications"].withColumn("furthest_stage", F.lit("applied"))
    filled = clean["vacancies"].where("status = 'filled'")
    chosen = shaping.one_per_key(applications, "vacancy_id", "application_id", ["application_id", "candidate_id"])
    marked = shaping.mark_chosen(applications, chosen, ["application_id"], "furthest_stage", "hired")
    assert marked.where("furthest_stage = 'hired'").count() == 6  # one per vacancy with applications
    columns = {"vacancy_id": F.col("vacancy_id"), "candidate_id": F.col("candidate_id"), "placed_at": F.col("closed_at")}
    placed = shaping.placements_from(filled, chosen, "vacancy_id", columns, "placement_id", "p_", 4)
    assert sorted(collected(placed)) == [
        ("p_0001", "v_0001", "cand_00001", day("2025-02-09")), ("p_0002", "v_0002", "cand_00003", day("2025-02-10")),
        ("p_0003", "v_0005", "cand_00005", day("2025-03-20")), ("p_0004", "v_0006", "cand_00003", day("2025-03-12")),
    ]


def test_faults_touch_only_the_first_rows(clean):
    left = faults.drop_rarest_parent(clean["clients"], "client_id", clean["vacancies"], "client_id")
    assert [r.client_id for r in left.orderBy("client_id").collect()] == ["c_001", "c_002"]
    twice = faults.duplicate_first(clean["placements"], "placement_id")
    assert [r.placement_id for r in twice.orderBy("placement_id").collect()].count("p_0001") == 2
    cleared = faults.clear_on_first(clean["vacancies"], "vacancy_id", F.col("status") == "open", "status")
    assert [r.vacancy_id for r in cleared.where("status is null").collect()] == ["v_0003"]
    negative = faults.negate_first(clean["marketing_daily"], ["date", "channel"], "spend_usd", 2)
    assert sorted(r.spend_usd for r in negative.collect()) == [-40.25, -30.1, 18.0, 44.8]


def test_clearing_nothing_changes_nothing(clean):
    same = faults.clear_on_first(clean["vacancies"], "vacancy_id", F.col("status") == "nowhere", "status")
    assert sorted(collected(same)) == sorted(collected(clean["vacancies"]))
