"""Matching one table against another by key: members, orphans and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _parent_keys(parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str]) -> DataFrame:
    renamed = parent.select(*[F.col(p).alias(k) for k, p in zip(keys, parent_keys)])
    return renamed.where(_present(keys)).distinct()


def orphan_rows(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """Child rows with no parent. A row with a missing key is an orphan by definition.

    Rows with a missing key skip the join, so a mostly empty foreign key does not pile
    up in one shuffle partition; the parent side is reduced to its distinct keys first.
    """
    parents = _parent_keys(parent, keys, parent_keys or keys)
    keyless = child.where(~_present(keys))
    unmatched = child.where(_present(keys)).join(parents, list(keys), "left_anti")
    return unmatched.select(child.columns).unionByName(keyless)


def member_rows(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """Child rows that have a parent, each once."""
    parents = _parent_keys(parent, keys, parent_keys or keys)
    return child.where(_present(keys)).join(parents, list(keys), "left_semi").select(child.columns)


def orphan_count(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """One row: how many child rows have no parent.

    The child is counted per key before the anti join, so a hot key crosses the shuffle as
    one row per task and joins as a single row. Adaptive execution broadcasts a side that it
    has seen to be small.
    """
    rows = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    orphans = orphan_rows(rows, parent, keys, parent_keys)
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))


def all_members(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None
) -> DataFrame:
    """One row: is every child row's key found in the parent? True for an empty child."""
    return orphan_count(child, parent, keys, parent_keys).select((F.col("orphans") == 0).alias("holds"))


# --- orphans against a parent much larger than the child --------------------------------------

BITS_PER_KEY = 16  # of the filter, for each key of the child: about 6 % of other keys pass
MOST_BITS = 1 << 28  # 32 MB: a larger filter is not built
WORDS = 1 << 10  # 64-bit words in a row of the filter


def key_filter(keyed: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(chunk, words): a bit for the hash of every key, in rows of 65,536 bits. Bits, a power of two, bound its size: bits / 8 bytes."""
    spots = keyed.select(F.pmod(F.xxhash64(*keys), F.lit(bits)).alias("spot"))
    marked = spots.select(F.expr("spot div 64").alias("word"), F.expr("shiftleft(1L, CAST(spot % 64 AS INT))").alias("bit"))
    masks = marked.groupBy("word").agg(F.bit_or("bit").alias("mask"))
    held = masks.groupBy(F.expr(f"word div {WORDS}").alias("chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.expr(f"CAST(word % {WORDS} AS INT)"), "mask"))).alias("held")
    )
    return held.select("chunk", F.expr(f"transform(sequence(0, {WORDS - 1}), i -> coalesce(try_element_at(held, i), 0L))").alias("words"))


def likely_members(rows: DataFrame, keys: Sequence[str], filtered: DataFrame, bits: int) -> DataFrame:
    """The rows whose key the filter may hold; no row with a key in it is lost. The filter is broadcast: at most bits / 8 bytes."""
    spotted = rows.withColumn("_spot", F.pmod(F.xxhash64(*keys), F.lit(bits)))
    chunk = F.expr(f"_spot div {WORDS * 64}")
    joined = spotted.join(F.broadcast(filtered.withColumnRenamed("chunk", "_chunk")), chunk == F.col("_chunk"))
    held = F.expr(f"shiftright(element_at(words, CAST(_spot div 64 % {WORDS} AS INT) + 1), CAST(_spot % 64 AS INT)) & 1L") == 1
    return joined.where(held).select(*rows.columns)


def orphan_count_of_few(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], parent_keys: Sequence[str] | None = None,
) -> DataFrame:
    """``orphan_count`` for a parent much larger than the child: parent rows that match no child are left out before they are shuffled.

    The child is counted per key first (one count reaches the driver), which sizes a bit filter of its keys: 16 bits a key, at
    most 32 MB. Beyond that the child is not small, and nothing is filtered; nor is it when keys differ in type, as their hashes then do. The
    result is the same either way.
    """
    counted = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    held = counted.where(_present(keys)).count()
    bits = 1 << max(16, (held * BITS_PER_KEY - 1).bit_length())
    renamed = parent.select(*[F.col(p).alias(k) for k, p in zip(keys, parent_keys or keys)])
    if bits <= MOST_BITS and all(renamed.schema[k].dataType == child.schema[k].dataType for k in keys):
        renamed = likely_members(renamed, list(keys), key_filter(counted.where(_present(keys)), list(keys), bits), bits)
    orphans = orphan_rows(counted, renamed, keys)
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))
