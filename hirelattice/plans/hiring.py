"""Hiring tables shaped from the star tables, so that the domain reports run on large data.

An order becomes a vacancy, a line item an application, a part a candidate, a customer a
client and a deal, an event type an advertising channel. The shaping steps are those a
hiring data set needs: sequential ids, first-seen dates, attribute lookup by number,
right-censoring, stage marking, placements, a calendar of channel days.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar_day, clip, exact_total, padded_id, trailing_number
from ..operators import matching, shaping
from ..session import bound_tasks, materialise
from . import star

Tables = Mapping[str, DataFrame]

# Parameters of the shaping.
FIRST_DAY = "1995-02-01"
HORIZON = "2001-06-30"
PART_CHANNELS = {
    "ECONOMY": "click", "SMALL": "view", "PROMO": "purchase", "LARGE": "signup",
    "MEDIUM": "Referral", "STANDARD": "Outbound",
}
DEAL_STAGES = {
    "BUILDING": "won", "MACHINERY": "won", "HOUSEHOLD": "lost", "FURNITURE": "lost", "AUTOMOBILE": "open",
}


_NUMBERED = ("applications", "placements")


def _mapped(column: str, values: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs)[F.col(column)]


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def clients(t: Tables) -> DataFrame:
    return t["customer"].select(
        padded_id("c_", F.col("c_custkey") + 1, 3).alias("client_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("country"),
        F.date_add(_date("1994-01-01"), F.col("c_nationkey")).alias("signed_at"),
    )


def vacancies(t: Tables) -> DataFrame:
    opened = F.greatest(calendar_day("o_orderdate"), _date(FIRST_DAY))
    days = clip(F.floor(F.col("o_totalprice") / 4000).cast("int"), 10, 100)
    price = F.col("o_totalprice")
    raw = t["orders"].select(
        F.col("o_orderkey").alias("vacancy_no"),
        padded_id("v_", F.col("o_orderkey") + 1, 4).alias("vacancy_id"),
        padded_id("c_", F.col("o_custkey") + 1, 3).alias("client_id"),
        F.col("o_orderpriority").alias("role_title"),
        F.col("o_orderpriority").alias("department"),
        F.when(price < 150000, "junior").when(price < 350000, "mid").otherwise("senior").alias("seniority"),
        opened.alias("opened_at"),
        F.when(F.col("o_orderstatus") != star.OPEN, F.date_add(opened, days)).alias("closed_at"),
        _mapped("o_orderstatus", {"F": "filled", "P": "cancelled", "O": "open"}).alias("status"),
        (F.floor(price / 1000) * 10).cast("bigint").alias("salary_offered_usd_month"),
    )
    return shaping.censor_after(raw, "status", "closed_at", _date(HORIZON), "open")


def hired_rows(rows: DataFrame, filled: DataFrame) -> DataFrame:
    """The first application of every filled vacancy that has any; of equal ones the first copy."""
    rest = [c for c in rows.columns if c != "vacancy_no"]
    first = shaping.one_per_key(rows.withColumn("_order", F.struct(*rest)), "vacancy_no", "_order", rest)
    return matching.member_rows(first, filled, ["vacancy_no"]).withColumn("copy", F.lit(1).cast("bigint"))


def drawn_applications(t: Tables, filled: DataFrame) -> DataFrame:
    """Applications in the order of vacancies, candidates and days, with the hired ones marked.

    Everything runs on numbers: ids are texts, slower to sort and wrong in order once they outgrow
    their width. Who is hired is settled before the rows are numbered, so they are written once, and in the
    order in which the marking leaves them, so they are sorted once.
    """
    drawn = (
        F.when(F.col("l_returnflag") == "A", "applied")
        .when(F.col("l_returnflag") == "N", "screened")
        .when(F.col("l_linestatus") == "O", "interview")
        .otherwise("offer")
    )
    rows = t["lineitem"].select(
        F.col("l_orderkey").alias("vacancy_no"), F.col("l_partkey").alias("candidate_no"),
        calendar_day("l_shipdate").alias("applied_at"), drawn.alias("drawn"),
    )
    keys = [*rows.columns, "copy"]
    copies = shaping.number_copies(rows, "copy").withColumn("furthest_stage", F.col("drawn"))
    marked = shaping.mark_chosen(copies, hired_rows(rows, filled), keys, "furthest_stage", "hired")
    numbered = shaping.sequential_ids(marked, keys, "application_id", "app_", 6, ordered=True)
    return numbered.select(
        "application_id",
        "vacancy_no",
        padded_id("v_", F.col("vacancy_no") + 1, 4).alias("vacancy_id"),
        padded_id("cand_", F.col("candidate_no") + 1, 5).alias("candidate_id"),
        "applied_at",
        "furthest_stage",
    )


def candidates(applications: DataFrame, t: Tables) -> DataFrame:
    seen = shaping.first_seen(applications, "candidate_id", "applied_at", "created_at")
    attributes = t["part"].select(
        "p_partkey", F.col("p_brand").alias("country"), _mapped("p_type", PART_CHANNELS).alias("source_channel")
    )
    number = trailing_number("candidate_id", "cand_") - 1
    return shaping.attach_by_number(seen, number, attributes, "p_partkey").select(
        "candidate_id", "country", "source_channel", "created_at"
    )


def placements(filled: DataFrame, chosen: DataFrame) -> DataFrame:
    salary = F.col("salary_offered_usd_month")
    columns = {
        "vacancy_no": F.col("vacancy_no"),
        "vacancy_id": F.col("vacancy_id"),
        "candidate_id": F.col("candidate_id"),
        "placed_at": F.col("closed_at"),
        "monthly_salary_usd": salary,
        "placement_fee_usd": F.round(salary * 1.25, 2),
    }
    return shaping.placements_from(filled, chosen, "vacancy_no", columns, "placement_id", "p_", 4).drop("vacancy_no")


def marketing_daily(t: Tables) -> DataFrame:
    """Every channel on every day between the first and the last event, active or not.

    The events are read once; bounds and channels come from the daily totals.
    """
    events = t["events"].select(
        calendar_day("ts").alias("date"), F.col("event_type").alias("channel"), "value"
    )
    daily = events.groupBy("date", "channel").agg(
        exact_total("value").alias("spend_usd"),
        F.count(F.lit(1)).alias("clicks"),
        F.count_if(F.col("value") > 50).alias("leads"),
    )
    daily = materialise(daily, "daily")
    start, end = (daily.agg(f("date")).scalar() for f in (F.min, F.max))
    spine = shaping.calendar_spine(daily.select("channel").distinct(), start, end, "date")
    joined = spine.join(daily, ["date", "channel"], "left").fillna(0, ["spend_usd", "clicks", "leads"])
    campaign = F.when(F.weekday("date") < 5, "weekday push").otherwise("weekend push")
    return joined.select(
        "date", "channel", campaign.alias("campaign_name"), "spend_usd",
        (F.col("clicks") * 40).alias("impressions"), "clicks", "leads",
    )


def sales_deals(t: Tables) -> DataFrame:
    created = F.date_add(_date("2001-01-01"), F.col("c_nationkey") * 6)
    stage = _mapped("c_mktsegment", DEAL_STAGES)
    raw = t["customer"].select(
        padded_id("d_", F.col("c_custkey") + 1, 4).alias("deal_id"),
        F.concat(F.lit("rep "), F.col("c_nationkey").cast("string")).alias("owner"),
        stage.alias("stage"),
        F.abs("c_acctbal").alias("amount_usd"),
        created.alias("created_at"),
        F.when(stage != "open", F.date_add(created, 45)).alias("closed_at"),
        padded_id("c_", F.col("c_custkey") + 1, 3).alias("client_id"),
    )
    censored = shaping.censor_after(raw, "stage", "closed_at", _date(HORIZON), "open")
    return censored.withColumn("client_id", F.when(F.col("stage") == "won", F.col("client_id")))


def hiring_tables(t: Tables) -> dict[str, DataFrame]:
    """The seven hiring tables. Numbered tables are written to the shared folder on the way."""
    all_vacancies = vacancies(t)
    filled = all_vacancies.where(F.col("status") == "filled")
    drawn = drawn_applications(t, filled)
    hired = drawn.where(F.col("furthest_stage") == "hired").select("vacancy_no", "candidate_id")
    return {
        "clients": clients(t),
        "vacancies": all_vacancies.drop("vacancy_no"),
        "candidates": candidates(drawn, t),
        "applications": drawn.drop("vacancy_no"),
        "placements": placements(filled, hired),
        "marketing_daily": marketing_daily(t),
        "sales_deals": sales_deals(t),
    }


def store_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Shape the hiring tables of a folder, write each once to the shared folder, read them back.

    The writes do not depend on each other, so they are submitted together and share the cluster.
    Numbered tables have been written by the numbering.
    """
    shaped = hiring_tables(star.read_tables(spark, folder))
    with ThreadPoolExecutor(len(shaped)) as pool:
        stored = pool.map(lambda name: shaped[name] if name in _NUMBERED else materialise(shaped[name], name), shaped)
        return dict(zip(shaped, stored))


_STORED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The hiring tables of a folder, stored on first use in an application."""
    bound_tasks(spark)
    at = (spark.sparkContext.applicationId, folder)
    if at not in _STORED:
        _STORED[at] = store_tables(spark, folder)
    return _STORED[at]
