"""Business metrics over any table that has the right column roles.

Groups (departments, channels, months, stages) are few, so each report is one partial
aggregation next to the scan and a small shuffle; a hot group collapses to one row per
task before anything moves. Sorting happens on the aggregated rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_between, exact_mean, exact_total, month_of, percentage, safe_ratio


def row_count() -> Column:
    return F.count(F.lit(1))


def mean_duration_by(
    df: DataFrame, key: str, start: str, end: str, *, counted: str, mean: str, digits: int = 1
) -> DataFrame:
    """Rows and mean days from ``start`` to ``end`` per key, longest first.

    The count takes every row; the mean skips rows that lack either date.
    """
    return (
        df.groupBy(key)
        .agg(
            row_count().alias(counted),
            F.round(F.avg(days_between(start, end)), digits).alias(mean),
        )
        .orderBy(F.desc(mean), key)
    )


def rate_by(
    df: DataFrame, key: Column, hit: Column, *, total: str, hits: str, rate: str, digits: int
) -> DataFrame:
    """Rows, hits and the hit percentage per key (unordered). NULL predicates are no hits."""
    return (
        df.groupBy(key)
        .agg(row_count().alias(total), F.count_if(hit).alias(hits))
        .withColumn(rate, percentage(F.col(hits), F.col(total), digits))
    )


def _looked_up_in_place(lookup: DataFrame) -> bool:
    """Does the engine's own estimate of ``lookup`` lie below its threshold for broadcast joins?"""
    threshold = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate <= threshold


def _counts_per_group(
    facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, group: str, counts: dict[str, Column]
) -> DataFrame:
    """Counts of fact rows per ``group`` of the matching ``dim`` rows, as a plain join gives.

    Next to a ``dim`` that the engine would broadcast, the facts are joined where they are read and only groups move. Else they
    are counted per join key first, so a key that holds a third of them joins as one row and the join reuses the
    partitioning. The result is the same; duplicate ``dim`` rows multiply the counts.
    """
    keyed = facts.where(F.col(fact_key).isNotNull()).withColumnRenamed(fact_key, "_key")
    lookup = dim.select(F.col(dim_key).alias("_key"), F.col(group).alias("_group"))
    if _looked_up_in_place(lookup):
        return keyed.join(lookup, "_key").groupBy(F.col("_group").alias(group)).agg(*[c.alias(n) for n, c in counts.items()])
    per_key = keyed.groupBy("_key").agg(*[c.alias(n) for n, c in counts.items()])
    joined = per_key.join(lookup, "_key")
    return joined.groupBy(F.col("_group").alias(group)).agg(*[F.sum(n).alias(n) for n in counts])


def rate_by_lookup(
    facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, group: str, hit: Column,
    *, total: str, hits: str, rate: str, digits: int,
) -> DataFrame:
    """``rate_by`` over an inner join, with ``group`` taken from ``dim``; best rate first."""
    counts = {total: row_count(), hits: F.count_if(hit)}
    return (
        _counts_per_group(facts, fact_key, dim, dim_key, group, counts)
        .withColumn(rate, percentage(F.col(hits), F.col(total), digits))
        .orderBy(F.desc(rate), group)
    )


def count_by_lookup(
    facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, group: str, *, counted: str
) -> DataFrame:
    """Fact rows per ``group`` of the matching ``dim`` rows."""
    return _counts_per_group(facts, fact_key, dim, dim_key, group, {counted: row_count()})


def cost_per_outcome(
    outcomes: DataFrame, spend: DataFrame, key: str, spend_key: str, amount: str,
    *, counted: str, total: str, cost: str, digits: int = 2,
) -> DataFrame:
    """Spend per outcome for every key of ``outcomes`` (one row per key already).

    Keys without spend stay, with NULL; keys with spend and no outcome disappear. The
    unrounded spend is divided, then rounded. NULL costs come first, as for any
    ascending sort here. Both join sides are one row per key.
    """
    spent = spend.groupBy(F.col(spend_key).alias(key)).agg(exact_total(amount).alias("_spent"))
    return (
        outcomes.join(spent, key, "left")
        .select(
            key,
            counted,
            F.round("_spent", digits).alias(total),
            F.round(safe_ratio(F.col("_spent"), F.col(counted)), digits).alias(cost),
        )
        .orderBy(F.asc_nulls_first(cost), key)
    )


def monthly_totals(df: DataFrame, day: str, amount: str, *, month: str, total: str) -> DataFrame:
    """Unrounded total per month; rows without a day form the NULL month."""
    return df.groupBy(month_of(day).alias(month)).agg(exact_total(amount).alias(total))


def period_totals(
    df: DataFrame, day: str, amount: str,
    *, month: str, counted: str, total: str, mean: str, digits: int = 2,
) -> DataFrame:
    """Rows, total and mean amount per month, NULL month first."""
    return (
        df.groupBy(month_of(day).alias(month))
        .agg(
            row_count().alias(counted),
            F.round(exact_total(amount), digits).alias(total),
            F.round(exact_mean(amount), digits).alias(mean),
        )
        .orderBy(F.asc_nulls_first(month))
    )


def stage_totals(
    df: DataFrame, stage: str, amount: str, *, counted: str, total: str, digits: int = 2
) -> DataFrame:
    """Rows and total amount per stage, most rows first."""
    return (
        df.groupBy(stage)
        .agg(
            row_count().alias(counted),
            F.round(exact_total(amount), digits).alias(total),
        )
        .orderBy(F.desc(counted), stage)
    )


def cumulative_funnel(df: DataFrame, stage: str, steps: Sequence[tuple[str, str]], entered: str) -> DataFrame:
    """One row: rows that entered, then rows that reached each step or a later one.

    ``steps`` are (output column, stage value) in order. A row with an unknown or
    missing stage only counts as entered. All counts come from a single pass.
    """
    values = [value for _, value in steps]
    reached = [
        F.count_if(F.col(stage).isin(values[at:])).alias(name) for at, (name, _) in enumerate(steps)
    ]
    return df.agg(row_count().alias(entered), *reached)


def outcome_ratio(
    df: DataFrame, stage: str, win: str, loss: str, *, won: str, lost: str, rate: str, digits: int = 1
) -> DataFrame:
    """One row: wins, losses and the share of wins among both; NULL share when both are 0."""
    counts = df.agg(
        F.count_if(F.col(stage) == win).alias(won), F.count_if(F.col(stage) == loss).alias(lost)
    )
    return counts.withColumn(rate, percentage(F.col(won), F.col(won) + F.col(lost), digits))


def latest_rows(df: DataFrame, instant: str, tie: str, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows; equal instants are ordered by ``tie`` (highest first)."""
    return df.orderBy(F.desc(instant), F.desc(tie)).limit(n).select(*columns)


def rarest_value(df: DataFrame, key: str, counted: str = "rows") -> DataFrame:
    """The least frequent non-NULL value of ``key`` (one row); ties go to the smaller value."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(row_count().alias(counted))
        .orderBy(F.asc(counted), F.asc(key))
        .limit(1)
    )


def every_row(df: DataFrame, predicate: Column, name: str) -> DataFrame:
    """One row: does the predicate hold everywhere? True for an empty table.

    A NULL predicate counts as a violation, as a failed comparison does.
    """
    held = F.bool_and(F.coalesce(predicate, F.lit(False)))
    return df.agg(F.coalesce(held, F.lit(True)).alias(name))
