"""Table-shaping steps: derived dimensions, ids, calendars, censoring, stage marking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import padded_id
from ..session import materialise

# Copies of one row that a task unfolds at once.
_COPY_CHUNK = 100_000


def first_seen(df: DataFrame, key: str, day: str, name: str) -> DataFrame:
    """Earliest day per key. Partial aggregation leaves one row per key and task."""
    return df.groupBy(key).agg(F.min(day).alias(name))


def attach_by_number(
    df: DataFrame, number: Column, attributes: DataFrame, number_column: str
) -> DataFrame:
    """Attach attribute columns found under the number an id carries.

    ``attributes`` holds one row per number. Rows without attributes keep NULLs.
    """
    lookup = attributes.withColumnRenamed(number_column, "_number")
    return df.withColumn("_number", number).join(lookup, "_number", "left").drop("_number")


def number_copies(df: DataFrame, name: str) -> DataFrame:
    """Give equal rows the numbers 1, 2, 3 ... in ``name``; a row without copies gets 1.

    Copies are counted, not gathered, so a row that makes up a third of the table shrinks
    to one row per task. A group unfolds chunk by chunk, so no row holds more than a chunk's
    numbers. Unlike a random salt the numbers are the same when a lost task runs again.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    copies = F.col("_copies")
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((copies - 1) / _COPY_CHUNK))
    start = F.col("_chunk") * _COPY_CHUNK
    return (
        counted
        .withColumn("_chunk", F.explode(chunks))
        .select(*df.columns, F.explode(F.sequence(start + 1, F.least(start + _COPY_CHUNK, copies))).alias(name))
    )


def sequential_ids(
    df: DataFrame, order_by: Sequence[str], name: str, prefix: str, width: int,
    *, unique: bool = False, ordered: bool = False, number: str | None = None,
) -> DataFrame:
    """Number the rows 1, 2, 3 ... in the order of ``order_by`` and format the ids.

    ``number`` names a column that keeps the plain number, which sorts right at any size.

    The remaining columns break ties, and copies are numbered first so that the sort can
    spread them too; ``unique`` states that ``order_by`` identifies a row and skips both;
    ``ordered`` that ``df`` is so sorted already, over its partitions and in them, as ``mark_chosen`` leaves it.
    The data is range-sorted in parallel and written once with each row's place inside
    its partition, so the places cannot change afterwards. What is added up across
    partitions is one count per partition, not the rows.
    """
    within_bits = 33  # monotonically_increasing_id: partition above, place below
    if ordered:
        rows = df
    elif unique:
        rows = df.orderBy(*order_by)
    else:
        rest = [c for c in df.columns if c not in order_by]
        rows = number_copies(df, "_copy").orderBy(*order_by, *rest, "_copy").drop("_copy")
    placed = materialise(rows.withColumn("_place", F.monotonically_increasing_id()), "ids")
    part = F.shiftright("_place", within_bits)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One task, over one row per partition of the sorted copy.
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    # At most one row per partition of the sorted copy: a proven bound for the broadcast.
    offsets = sizes.select("_part", before.alias("_before"))
    within = F.col("_place").bitwiseAND(F.lit((1 << within_bits) - 1))
    count = F.col("_before") + within + F.lit(1)
    plain = [] if number is None else [count.alias(number)]
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*plain, padded_id(prefix, count, width).alias(name), *df.columns)
    )


def calendar_spine(channels: DataFrame, start: Column, end: Column, day: str) -> DataFrame:
    """One row per day and channel. Each channel row unfolds its own days: no product join."""
    days = F.sequence(start, end, F.expr("INTERVAL 1 DAY"))
    return channels.select(F.explode(days).alias(day), "*")


def censor_after(
    df: DataFrame, status: str, closed: str, horizon: Column, open_status: str
) -> DataFrame:
    """Anything that would close after the horizon is still open, without a close date."""
    late = F.col(closed) > horizon
    return df.withColumns(
        {
            status: F.when(late, F.lit(open_status)).otherwise(F.col(status)),
            closed: F.when(~late, F.col(closed)),
        }
    )


def mark_chosen(
    df: DataFrame, chosen: DataFrame, keys: Sequence[str], stage: str, chosen_stage: str
) -> DataFrame:
    """Set ``stage`` to ``chosen_stage`` on the rows whose keys are in ``chosen``; missing values are equal.

    Rows and marks are dealt to ranges of the keys together and meet next to each other, so no row is shuffled
    or sorted a second time: the result is in the order of ``keys``, over its partitions and in them.
    """
    marks = chosen.select(*[F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys], F.lit(True).alias("_mark"))
    both = df.withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    marked = F.max("_mark").over(Window.partitionBy(*keys))
    met = both.repartitionByRange(*keys).withColumn("_chosen", marked).where(~F.col("_mark"))
    value = F.when(F.col("_chosen"), F.lit(chosen_stage)).otherwise(F.col(stage))
    return met.withColumn(stage, value).select(df.columns).sortWithinPartitions(*keys)


def one_per_key(df: DataFrame, key: str, order: str, keep: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, reduced to ``keep``; no window needed."""
    held = df.schema[order].dataType
    inside = isinstance(held, StructType) and set(keep) <= set(held.names)  # then the order has all that is kept
    best = F.min(order) if inside else F.min_by(F.struct(*keep), F.col(order))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(best.alias("_best"))
        .select(key, *[F.col(f"_best.{c}").alias(c) for c in keep])
    )


def placements_from(
    filled: DataFrame, chosen: DataFrame, key: str, columns: dict[str, Column],
    name: str, prefix: str, width: int,
) -> DataFrame:
    """One placement per filled vacancy with its chosen candidate, numbered by vacancy.

    Both sides hold a key at most once, so the join multiplies no rows and no key is hot.
    """
    joined = filled.join(chosen, key).select(*[c.alias(n) for n, c in columns.items()])
    return sequential_ids(joined, [key], name, prefix, width, unique=True)
