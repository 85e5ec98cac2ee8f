"""Deliberate faults, as pure DataFrame transforms, to prove that the checks notice them.

"First" means the smallest natural key, with the whole row to break ties. Ids are a prefix and a
number, so shorter ones come first. Only the one to three rows that change are looked up; they
travel as a broadcast of at most that many rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import rarest_value


def drop_rarest_parent(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str) -> DataFrame:
    """Remove the parent that the fewest child rows point to, orphaning those rows."""
    rarest = rarest_value(child, child_key).select(F.col(child_key).alias(parent_key))
    return parent.join(F.broadcast(rarest), parent_key, "left_anti").select(parent.columns)


def _by_id(key: str) -> list[Column]:
    return [F.length(key), F.col(key)]


def duplicate_first(df: DataFrame, key: str) -> DataFrame:
    """Append a copy of the first row."""
    return df.unionByName(df.orderBy(*_by_id(key), *df.columns).limit(1))


def _change(df: DataFrame, rows: DataFrame, target: str, value: Column) -> DataFrame:
    """Set ``target`` to ``value`` on exactly the given rows: of equal rows as many as are given.

    The rows are few. Copies of them in ``df`` are counted, not gathered, and unfold again.
    """
    hits = rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_hits"))
    here = hits.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(df.columns)), "_hits")
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(df.columns)))
    others = df.join(F.broadcast(here), same, "left_anti")
    copies = df.join(F.broadcast(here), same).groupBy(*df.columns, "_hits").agg(F.count(F.lit(1)).alias("_copies"))
    numbered = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
    changed = numbered.withColumn(target, F.when(F.col("_copy") <= F.col("_hits"), value).otherwise(F.col(target)))
    return others.unionByName(changed.select(df.columns))


def clear_on_first(df: DataFrame, key: str, where: Column, target: str) -> DataFrame:
    """Set ``target`` to NULL on the first row that meets ``where``."""
    first = df.where(where).orderBy(*_by_id(key), *df.columns).limit(1)
    return _change(df, first, target, F.lit(None).cast(df.schema[target].dataType))


def negate_first(df: DataFrame, keys: Sequence[str], target: str, n: int = 3) -> DataFrame:
    """Make ``target`` negative on the first ``n`` rows by key."""
    first = df.orderBy(*keys, *df.columns).limit(n)
    return _change(df, first, target, -F.abs(F.col(target)))


def fault_report(affected: dict[str, DataFrame]) -> DataFrame:
    """(issue, rows_affected) from one one-row count per issue."""
    rows = [
        count.select(F.lit(issue).alias("issue"), F.col(count.columns[0]).cast("bigint").alias("rows_affected"))
        for issue, count in affected.items()
    ]
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    return report
