"""Column functions used by the operators; all of them stay inside Spark's built-ins."""

from .dates import calendar_day, days_between, month_of, parse_day
from .numbers import clip, exact_mean, exact_total, percentage, safe_ratio
from .text import padded_id, plain_number, trailing_number

__all__ = [
    "calendar_day", "clip", "days_between", "exact_mean", "exact_total", "month_of",
    "padded_id", "parse_day", "percentage", "plain_number", "safe_ratio", "trailing_number",
]
