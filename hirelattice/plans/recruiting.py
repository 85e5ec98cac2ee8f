"""The recruiting reports and the recruiting check catalogue, on the domain tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import faults, matching, metrics
from ..schemas import BASE_TABLES
from ..sources.tables import replace_table
from .audit import IntegrityError, assert_all_pass, audit_fused
from .checks import (
    INTEGRITY, RECONCILIATION, VALIDITY, Check, MatchedTotal, MonthlyTotal, Rows, Surplus, Total, Unmatched,
)

Tables = Mapping[str, DataFrame]

TABLES = list(BASE_TABLES)

# Fixed values of the data model.
FILLED, OPEN, CANCELLED = "filled", "open", "cancelled"
HIRED = "hired"
WON, LOST = "won", "lost"
# (report column, stage value) in funnel order; "applied" is every row.
FUNNEL = [("screened", "screened"), ("interviewed", "interview"), ("offered", "offer"), ("hired", HIRED)]


# --- reports --------------------------------------------------------------------------


def time_to_fill_by_department(vacancies: DataFrame) -> DataFrame:
    filled = vacancies.where(F.col("status") == FILLED)
    return metrics.mean_duration_by(
        filled, "department", "opened_at", "closed_at", counted="filled_vacancies", mean="avg_days_to_fill"
    )


def fill_rate_by_open_month(vacancies: DataFrame) -> DataFrame:
    """Recent months read low: their vacancies have had little time to be filled."""
    return metrics.rate_by(
        vacancies, metrics.month_of("opened_at").alias("opened_month"), F.col("status") == FILLED,
        total="vacancies_opened", hits="vacancies_filled", rate="fill_rate_pct", digits=1,
    ).orderBy(F.asc_nulls_first("opened_month"))


def hiring_funnel(applications: DataFrame) -> DataFrame:
    return metrics.cumulative_funnel(applications, "furthest_stage", FUNNEL, "applied")


def hire_rate_by_channel(applications: DataFrame, candidates: DataFrame) -> DataFrame:
    return metrics.rate_by_lookup(
        applications, "candidate_id", candidates, "candidate_id", "source_channel",
        F.col("furthest_stage") == HIRED,
        total="applications", hits="hires", rate="hire_rate_pct", digits=2,
    )


def cost_per_hire_by_channel(
    applications: DataFrame, candidates: DataFrame, marketing_daily: DataFrame
) -> DataFrame:
    hired = applications.where(F.col("furthest_stage") == HIRED)
    hires = metrics.count_by_lookup(
        hired, "candidate_id", candidates, "candidate_id", "source_channel", counted="hires"
    ).withColumnRenamed("source_channel", "channel")
    return metrics.cost_per_outcome(
        hires, marketing_daily, "channel", "channel", "spend_usd",
        counted="hires", total="total_spend_usd", cost="cost_per_hire_usd",
    )


def monthly_revenue(placements: DataFrame) -> DataFrame:
    return metrics.period_totals(
        placements, "placed_at", "placement_fee_usd",
        month="placement_month", counted="placements", total="revenue_usd", mean="avg_fee_usd",
    )


def deals_by_stage(sales_deals: DataFrame) -> DataFrame:
    return metrics.stage_totals(sales_deals, "stage", "amount_usd", counted="deals", total="total_amount_usd")


def win_rate(sales_deals: DataFrame) -> DataFrame:
    return metrics.outcome_ratio(
        sales_deals, "stage", WON, LOST, won="won", lost="lost", rate="win_rate_pct"
    )


# --- checks ---------------------------------------------------------------------------


_FILLED = f"status = '{FILLED}'"
_HIRED = f"furthest_stage = '{HIRED}'"
_FEES = Total("placements", "placement_fee_usd")

# Check names and types are fixed values of the audit table.
CHECKS = [
    Check(INTEGRITY, "orphan_vacancies_client", "Each vacancy names a client that exists",
          Unmatched("vacancies", ("client_id",), "clients", ("client_id",))),
    Check(INTEGRITY, "orphan_applications_vacancy", "Each application names a vacancy that exists",
          Unmatched("applications", ("vacancy_id",), "vacancies", ("vacancy_id",))),
    Check(INTEGRITY, "orphan_applications_candidate", "Each application names a candidate that exists",
          Unmatched("applications", ("candidate_id",), "candidates", ("candidate_id",))),
    Check(INTEGRITY, "orphan_placements_vacancy", "Each placement names a vacancy that exists",
          Unmatched("placements", ("vacancy_id",), "vacancies", ("vacancy_id",))),
    Check(INTEGRITY, "duplicate_vacancy_id", "No vacancy_id is missing or repeated",
          Surplus("vacancies", "vacancy_id")),
    Check(INTEGRITY, "duplicate_application_id", "No application_id is missing or repeated",
          Surplus("applications", "application_id")),
    Check(INTEGRITY, "duplicate_placement_id", "No placement_id is missing or repeated",
          Surplus("placements", "placement_id")),
    Check(RECONCILIATION, "placements_vs_filled_vacancies", "As many placements as filled vacancies",
          Rows("placements"), expected=Rows("vacancies", _FILLED)),
    Check(RECONCILIATION, "hired_applications_vs_placements", "As many hired applications as placements",
          Rows("placements"), expected=Rows("applications", _HIRED)),
    Check(RECONCILIATION, "placements_without_hired_application",
          "Each placement has a hired application of its candidate for its vacancy",
          Unmatched("placements", ("vacancy_id", "candidate_id"), "applications", ("vacancy_id", "candidate_id"),
                    _HIRED, witness="application_id")),
    Check(RECONCILIATION, "revenue_total_vs_monthly_report",
          "All fees appear in the monthly revenue, none is lost for want of a date",
          MonthlyTotal("placements", "placement_fee_usd", "placed_at"), expected=_FEES),
    Check(RECONCILIATION, "revenue_total_vs_filled_vacancies", "All fees belong to filled vacancies",
          MatchedTotal("placements", "placement_fee_usd", ("vacancy_id",), "vacancies", ("vacancy_id",),
                       _FILLED), expected=_FEES),
    Check(VALIDITY, "filled_vacancies_missing_close_date", "A filled vacancy has been closed",
          Rows("vacancies", f"{_FILLED} AND closed_at IS NULL")),
    Check(VALIDITY, "open_vacancies_with_close_date", "An open vacancy has not been closed",
          Rows("vacancies", f"status = '{OPEN}' AND closed_at IS NOT NULL")),
    Check(VALIDITY, "closed_before_opened", "A vacancy closes on or after the day it opens",
          Rows("vacancies", "closed_at < opened_at")),
    Check(VALIDITY, "negative_or_missing_marketing_spend", "Spend is known and at least zero",
          Rows("marketing_daily", "spend_usd IS NULL OR spend_usd < 0")),
    Check(VALIDITY, "clicks_exceed_impressions", "An ad is clicked at most as often as it is shown",
          Rows("marketing_daily", "clicks > impressions")),
    Check(VALIDITY, "won_deals_without_client", "A won deal has its client",
          Rows("sales_deals", f"stage = '{WON}' AND client_id IS NULL")),
    Check(VALIDITY, "closed_deals_without_close_date", "A won or lost deal has its close date",
          Rows("sales_deals", f"stage IN ('{WON}', '{LOST}') AND closed_at IS NULL")),
]

# The generator's gate also ties placements to candidates, which no audit row does.
PLACED_CANDIDATES = Check(
    INTEGRITY, "orphan_placements_candidate", "Each placement names a candidate that exists",
    Unmatched("placements", ("candidate_id",), "candidates", ("candidate_id",)),
)

# The nine conditions data must meet before it is written.
_GATE_NAMES = {
    "orphan_vacancies_client", "orphan_applications_vacancy", "orphan_applications_candidate",
    "orphan_placements_vacancy", "placements_vs_filled_vacancies", "hired_applications_vs_placements",
    "closed_before_opened", "open_vacancies_with_close_date",
}
GATE = [c for c in CHECKS if c.check_name in _GATE_NAMES] + [PLACED_CANDIDATES]


def audit_checks(tables: Tables) -> DataFrame:
    """The nineteen checks, scored."""
    return audit_fused(CHECKS, tables)


def integrity_gate(tables: Tables) -> None:
    """Raise unless the tables may be written."""
    assert_all_pass(audit_fused(GATE, tables))


def write_if_sound(tables: Tables, namespace: str) -> int:
    """Store the tables if they pass the gate; returns how many were written."""
    try:
        integrity_gate(tables)
    except IntegrityError:
        return 0
    for name in TABLES:
        replace_table(tables[name], f"{namespace}.{name}")
    return len(TABLES)


# --- faults ---------------------------------------------------------------------------


def inject_faults(tables: Tables) -> dict[str, DataFrame]:
    """The five demonstration faults, on copies; the other tables pass through."""
    clients, vacancies = tables["clients"], tables["vacancies"]
    deals = tables["sales_deals"]
    return {
        **tables,
        "clients": faults.drop_rarest_parent(clients, "client_id", vacancies, "client_id"),
        "placements": faults.duplicate_first(tables["placements"], "placement_id"),
        "vacancies": faults.clear_on_first(vacancies, "vacancy_id", F.col("status") == FILLED, "closed_at"),
        "marketing_daily": faults.negate_first(tables["marketing_daily"], ["date", "channel"], "spend_usd"),
        "sales_deals": faults.clear_on_first(deals, "deal_id", F.col("stage") == WON, "client_id"),
    }


def injected_report(clean: Tables, faulty: Tables) -> DataFrame:
    """Rows each fault touched, counted by comparing the tables before and after."""

    def added(table: str, where) -> DataFrame:
        before = clean[table].agg(F.count_if(where).alias("n")).scalar()
        return faulty[table].agg((F.count_if(where) - before).alias("n"))

    no_close = (F.col("status") == FILLED) & F.col("closed_at").isNull()
    no_client = (F.col("stage") == WON) & F.col("client_id").isNull()
    rarest = metrics.rarest_value(clean["vacancies"], "client_id", "n").select("n")
    return faults.fault_report(
        {
            "drop_rarest_parent: clients": rarest,
            "duplicate_first: placements": added("placements", F.lit(True)),
            "clear_on_first: vacancies": added("vacancies", no_close),
            "negate_first: marketing_daily": added("marketing_daily", F.col("spend_usd") < 0),
            "clear_on_first: sales_deals": added("sales_deals", no_client),
        }
    )


def orphaned_vacancies(tables: Tables) -> DataFrame:
    """The vacancies behind ``orphan_vacancies_client``, for a closer look."""
    return matching.orphan_rows(tables["vacancies"], tables["clients"], ["client_id"])
