"""Reports and ids over tables that grow.

A monthly report keeps one mergeable state per month: counts and the whole parts of a total, which add up exactly in any
order. When rows are appended or a month is replaced, only the partitions of those months are read and only their states are
written anew. Doing a step again changes nothing, so a job that fails between the two writes is simply repeated.

Ids of appended rows continue behind a stored mark, so an id never changes and is never given twice, even after
rows are removed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_of
from ..functions.numbers import join_parts, total_parts, with_rest
from ..operators.shaping import sequential_ids
from ..session import materialise
from ..sources.tables import append_table, replace_partitions, replace_table

MONTH = "_month"


def month_states(rows: DataFrame, month: str, amount: str) -> DataFrame:
    """One row per month: rows, amounts, and the sums of the amounts' high and low parts and of the rest."""
    high, low, rest = total_parts(amount)
    return rows.groupBy(F.col(month).alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"count({amount})").alias("amounts"),
        F.expr(f"sum({high})").alias("high"), F.expr(f"sum({low})").alias("low"), F.expr(f"sum({rest})").alias("rest"),
    )


def merged(states: DataFrame) -> DataFrame:
    """States of the same month put together."""
    return states.groupBy("month").agg(*(F.sum(c).alias(c) for c in ("rows", "amounts", "high", "low", "rest")))


def totals_from_states(states: DataFrame, *, month: str, counted: str, total: str, mean: str, digits: int = 2) -> DataFrame:
    """The monthly report as ``period_totals`` makes it from all rows."""
    whole = with_rest(join_parts("high", "low"), "rest")
    return states.select(
        F.col("month").alias(month), F.col("rows").alias(counted), F.round(F.expr(whole), digits).alias(total),
        F.round(F.expr(f"try_divide({whole}, CAST(amounts AS DOUBLE))"), digits).alias(mean),
    ).orderBy(F.asc_nulls_first(month))


@dataclass(frozen=True)
class MonthlyTotals:
    """A table stored by month and the table of its months' states."""

    spark: SparkSession
    table: str
    states: str
    day: str
    amount: str

    def _by_month(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(MONTH, month_of(self.day))

    def build(self, rows: DataFrame) -> None:
        """Store all rows by month and the states of all months."""
        replace_table(self._by_month(rows), self.table, [MONTH])
        replace_table(month_states(self.spark.table(self.table), MONTH, self.amount), self.states)

    def append(self, rows: DataFrame, once: Sequence[str] = ()) -> None:
        """Append rows and refresh their months; ``once`` as in ``append_table``."""
        rows = materialise(self._by_month(rows), "appended")
        append_table(rows, self.table, [MONTH], once)
        self.refresh(rows)

    def replace_months(self, rows: DataFrame) -> None:
        """Put these rows in place of all stored rows of their months."""
        rows = materialise(self._by_month(rows), "replacing")
        replace_partitions(rows, self.table)
        self.refresh(rows)

    def refresh(self, rows: DataFrame) -> None:
        """State anew the months of ``rows``, read from the stored table; at most one value per month reaches the driver."""
        months = [r[0] for r in rows.select(MONTH).distinct().collect()]
        if not months:
            return
        kept = self.spark.table(self.states).where(~self._among(F.col("month"), months))
        replace_table(kept.unionByName(month_states(self.stored(months), MONTH, self.amount)), self.states)

    def stored(self, months: Sequence) -> DataFrame:
        """The stored rows of these months; other partitions are not read."""
        return self.spark.table(self.table).where(self._among(F.col(MONTH), months))

    @staticmethod
    def _among(column, months: Sequence):
        known = column.isin([m for m in months if m is not None])
        return F.coalesce(known, F.lit(False)) | column.isNull() if None in months else F.coalesce(known, F.lit(False))

    def report(self, **names: str) -> DataFrame:
        return totals_from_states(self.spark.table(self.states), **names)


# --- ids that hold ---------------------------------------------------------------------------


def append_numbered(
    rows: DataFrame, table: str, order_by: Sequence[str], name: str, prefix: str, width: int, batch: str,
) -> None:
    """Append rows with ids that continue those given before, in the order of ``order_by``; old ids stay.

    Given numbers are kept in ``<table>__given``, a row per batch with its first and last number. A batch reserves its
    numbers first, then appends its rows, each step once per batch name, so a batch that is repeated gets the same numbers again and leaves
    one copy of its rows. One writer at a time: numbers are taken from the last reservation.
    """
    spark, given = rows.sparkSession, f"{table}__given"
    numbered = sequential_ids(rows, order_by, name, prefix, width, number="_number")
    size = numbered.count()
    known = spark.table(given) if spark.catalog.tableExists(given) else spark.createDataFrame([], "batch string, first bigint, last bigint")
    mark = known.agg(F.max("last").alias("last"), F.max(F.when(F.col("batch") == batch, F.col("first"))).alias("own")).first()
    first = mark["own"] if mark["own"] is not None else (mark["last"] or 0) + 1
    append_table(spark.createDataFrame([(batch, first, first + size - 1)], known.schema), given, once=["batch"])
    shifted = numbered.withColumn("_number", F.col("_number") + F.lit(first - 1))
    text = F.lpad(F.col("_number").cast("string"), F.greatest(F.lit(width), F.length(F.col("_number").cast("string"))), "0")
    named = shifted.select(F.concat(F.lit(prefix), text).alias(name), *rows.columns, F.lit(batch).alias("batch"))
    append_table(named, table, once=["batch"])


# --- the newest rows -------------------------------------------------------------------------


def newest_rows(table: DataFrame, day: str, instant: str, tie: str, columns: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows of a table stored by day, from its newest partitions only.

    ``day`` is the partition column and the day of ``instant``. The days that are there come from the
    stored files' places, with a count a day from their footers; days are taken newest first until they hold ``n`` rows, and only
    those are read. At most one row a day reaches the driver.
    """
    days = table.groupBy(day).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc_nulls_last(day)).collect()
    taken, held = [], 0
    for row in days:
        if held >= n:
            break
        taken.append(row[0])
        held += row["rows"]
    known = [d for d in taken if d is not None]
    chosen = F.col(day).isin(known) if None not in taken else F.col(day).isin(known) | F.col(day).isNull()
    return table.where(chosen).orderBy(F.desc(instant), F.desc(tie)).limit(n).select(*columns)
