"""Declarative data-quality checks.

A check compares two measures. A measure says what to compute on named tables, with
conditions and amounts as SQL expressions; how the measures of a whole catalogue share
scans and shuffles is decided in ``audit``.
"""

from __future__ import annotations

from dataclasses import dataclass

# The check types of the audit table.
INTEGRITY = "integrity"
RECONCILIATION = "reconciliation"
VALIDITY = "validity"


@dataclass(frozen=True)
class Constant:
    """A fixed expected value."""

    value: int = 0


@dataclass(frozen=True)
class Rows:
    """Rows of ``table``, or those for which ``where`` is true (NULL is not true)."""

    table: str
    where: str | None = None


@dataclass(frozen=True)
class Total:
    """SUM of ``amount`` over ``table``, or over the rows meeting ``where``; NULL if none."""

    table: str
    amount: str
    where: str | None = None


@dataclass(frozen=True)
class MonthlyTotal:
    """The sum over a monthly report of ``amount``, leaving out the month-less group."""

    table: str
    amount: str
    day: str


@dataclass(frozen=True)
class Surplus:
    """Rows beyond one per distinct key. Rows without a key are all surplus."""

    table: str
    key: str


@dataclass(frozen=True)
class Unmatched:
    """Child rows without a parent row (one that meets ``parent_where``, if given).

    With ``witness``, a matching parent row whose witness column is NULL does not vouch
    for the child: each such pair counts too, as a left join with a null test would.
    """

    child: str
    keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]
    parent_where: str | None = None
    witness: str | None = None


@dataclass(frozen=True)
class MatchedTotal:
    """SUM of the child's ``amount`` over an inner join with the parent.

    Duplicate parents multiply the amount: the check has to notice them.
    """

    child: str
    amount: str
    keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]
    parent_where: str | None = None


Measure = Constant | Rows | Total | MonthlyTotal | Surplus | Unmatched | MatchedTotal


@dataclass(frozen=True)
class Check:
    check_type: str
    check_name: str
    description: str
    actual: Measure
    expected: Measure = Constant(0)
