import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hirelattice.schemas import BASE_TABLES  # noqa: E402
from hirelattice.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text):
    return date.fromisoformat(text) if text else None


@pytest.fixture(scope="session")
def rows():
    """A small agency without any fault, as plain rows per table."""
    return {
        "clients": [
            ("c_001", "Acme, Inc.", "SaaS", "United States", day("2024-06-01")),
            ("c_002", 'The "Best" Co', "Logistics", "Canada", day("2024-07-01")),
            ("c_003", "Umbrella", "SaaS", "United Kingdom", day("2024-08-01")),
        ],
        "vacancies": [
            ("v_0001", "c_001", "Data Analyst", "Data", "mid", day("2025-01-10"), day("2025-02-09"), "filled", 2250),
            ("v_0002", "c_001", "Bookkeeper", "Finance", "mid", day("2025-01-20"), day("2025-02-10"), "filled", 1800),
            ("v_0003", "c_002", "BI Developer", "Data", "senior", day("2025-02-01"), None, "open", 3250),
            ("v_0004", "c_002", "Account Executive", "Sales", "junior", day("2025-02-03"), day("2025-03-01"),
             "cancelled", 1100),
            ("v_0005", "c_003", "Account Executive", "Sales", "junior", day("2025-02-05"), day("2025-03-20"),
             "filled", 1100),
            ("v_0006", "c_001", "QA Analyst", "Data", "junior", day("2025-03-01"), day("2025-03-12"), "filled", 1370),
        ],
        "candidates": [
            ("cand_00001", "Chile", "Referral", day("2025-01-11")),
            ("cand_00002", "Peru", "LinkedIn Ads", day("2025-01-12")),
            ("cand_00003", "Brazil", "LinkedIn Ads", day("2025-01-21")),
            ("cand_00004", "Mexico", "Google Ads", day("2025-02-04")),
            ("cand_00005", "Peru", "Outbound", day("2025-02-06")),
        ],
        "applications": [
            ("app_000001", "v_0001", "cand_00001", day("2025-01-11"), "hired"),
            ("app_000002", "v_0001", "cand_00002", day("2025-01-12"), "interview"),
            ("app_000003", "v_0002", "cand_00003", day("2025-01-21"), "hired"),
            ("app_000004", "v_0002", "cand_00002", day("2025-01-22"), "screened"),
            ("app_000005", "v_0003", "cand_00001", day("2025-02-02"), "offer"),
            ("app_000006", "v_0004", "cand_00004", day("2025-02-04"), "applied"),
            ("app_000007", "v_0005", "cand_00005", day("2025-02-06"), "applied"),
            ("app_000008", "v_0005", "cand_00002", day("2025-02-07"), "hired"),
            ("app_000009", "v_0006", "cand_00003", day("2025-03-02"), "hired"),
        ],
        "placements": [
            ("p_0001", "v_0001", "cand_00001", day("2025-02-09"), 2240, 2912.37),
            ("p_0002", "v_0002", "cand_00003", day("2025-02-10"), 1805, 2001.1),
            ("p_0003", "v_0005", "cand_00002", day("2025-03-20"), 1090, 1199.99),
            ("p_0004", "v_0006", "cand_00003", day("2025-03-12"), 1400, 1500.0),
        ],
        "marketing_daily": [
            (day("2025-01-01"), "LinkedIn Ads", "candidate_sourcing", 40.25, 2000, 18, 1),
            (day("2025-01-01"), "Google Ads", "candidate_sourcing", 30.1, 900, 25, 2),
            (day("2025-01-02"), "LinkedIn Ads", "candidate_sourcing", 44.8, 2100, 20, 0),
            (day("2025-01-02"), "Meta Ads", "brand_awareness", 18.0, 1500, 22, 1),
        ],
        "sales_deals": [
            ("d_0001", "Ana", "won", 3000.5, day("2025-01-05"), day("2025-01-30"), "c_001"),
            ("d_0002", "Ana", "lost", 1200.0, day("2025-01-07"), day("2025-02-01"), None),
            ("d_0003", "Leo", "won", 2500.25, day("2025-02-05"), day("2025-03-01"), "c_003"),
            ("d_0004", "Leo", "open", 900.0, day("2025-03-05"), None, None),
        ],
    }


@pytest.fixture(scope="session")
def frames_of(spark):
    """Rows per table -> typed DataFrames, with optional replacements."""

    def build(rows, **replaced):
        return {
            name: spark.createDataFrame(replaced.get(name, data), BASE_TABLES[name]) for name, data in rows.items()
        }

    return build


@pytest.fixture(scope="session")
def clean(rows, frames_of):
    return frames_of(rows)


def collected(df):
    return [tuple(r) for r in df.collect()]
