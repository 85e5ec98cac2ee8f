"""Date helpers. Every result is a DATE or an INT, never a session-zone timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_of(day: Column | str) -> Column:
    """First day of the month, as a DATE; NULL stays NULL."""
    return F.trunc(_col(day), "MONTH")


def calendar_day(instant: Column | str) -> Column:
    """The UTC day of an instant in any session zone; a timestamp without zone or a date is taken as it is."""
    instant = _col(instant)
    utc = F.to_date(F.convert_timezone(None, F.lit("UTC"), instant))
    return F.when(F.typeof(instant) == "timestamp", utc).otherwise(F.to_date(instant))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end``; NULL when either is missing."""
    return F.date_diff(_col(end), _col(start))


def parse_day(text: Column | str) -> Column:
    """Text to DATE. Empty text is NULL, malformed text raises, whatever the session's settings."""
    text = F.nullif(F.trim(_col(text)), F.lit(""))
    return strict(text, F.try_to_date(text, "yyyy-MM-dd"), "a date")


def strict(text: Column, parsed: Column, kind: str) -> Column:
    """``parsed``, but raise where there is a text that it could not make sense of."""
    broken = F.raise_error(F.concat(F.lit(f"not {kind}: "), text))
    return F.when(parsed.isNull() & text.isNotNull(), broken).otherwise(parsed)
