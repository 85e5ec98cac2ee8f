"""Table schemas. Names, column order and types are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {
    "string": StringType(), "bigint": LongType(), "double": DoubleType(),
    "date": DateType(), "timestamp": TimestampType(),
}


def _schema(text: str) -> StructType:
    fields = [part.split() for part in text.split(",")]
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in fields])


BASE_TABLES: dict[str, StructType] = {
    "clients": _schema(
        "client_id string, company_name string, industry string, country string, signed_at date"
    ),
    "vacancies": _schema(
        "vacancy_id string, client_id string, role_title string, department string, seniority string,"
        "opened_at date, closed_at date, status string, salary_offered_usd_month bigint"
    ),
    "candidates": _schema(
        "candidate_id string, country string, source_channel string, created_at date"
    ),
    "applications": _schema(
        "application_id string, vacancy_id string, candidate_id string, applied_at date, furthest_stage string"
    ),
    "placements": _schema(
        "placement_id string, vacancy_id string, candidate_id string, placed_at date,"
        "monthly_salary_usd bigint, placement_fee_usd double"
    ),
    "marketing_daily": _schema(
        "date date, channel string, campaign_name string, spend_usd double,"
        "impressions bigint, clicks bigint, leads bigint"
    ),
    "sales_deals": _schema(
        "deal_id string, owner string, stage string, amount_usd double,"
        "created_at date, closed_at date, client_id string"
    ),
}

AUDIT = _schema(
    "check_type string, check_name string, description string, expected double, actual double,"
    "difference double, status string, checked_at timestamp"
)

RUN_LOG = _schema(
    "run_id string, run_type string, started_at timestamp, finished_at timestamp, status string,"
    "checks_total bigint, checks_failed bigint, error_message string"
)

FAILURE = _schema(
    "check_type string, check_name string, description string, expected double, actual double, status string"
)

PAYLOAD = StructType(
    [
        StructField("source", StringType()),
        StructField("project", StringType()),
        StructField("run_id", StringType()),
        StructField("status", StringType()),
        StructField("total", LongType()),
        StructField("failed", LongType()),
        StructField("passed", LongType()),
        StructField("failures", ArrayType(FAILURE)),
    ]
)
