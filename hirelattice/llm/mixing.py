"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL operations only.

Every source is a stream of blocks of equal size, its documents in an order drawn by hash. A source with s of the D
slots of a period has the weight s / D: its block j is released at slot floor(j D / s) and due at slot ceil((j + 1) D / s).
Earliest deadline first fills one period; since the slots add up to the period, every block is placed in its window and the
schedule repeats. So the place of any block follows from a table of one period, and at every slot each source has had its weight's
share of blocks to within less than one block, as long as all sources last. A document is emitted whole, in the slot of the block
in which it starts, so read in slot order a source may be ahead by its longest document more: less than one block behind, less
than one block and its longest document ahead. No document is left out or repeated; sources that end leave
their slots empty.

Target weights come as a table, or else follow the square root of the sources' sizes, which lifts small
sources. A period has about ``period`` slots, at least one per source.

Running sizes are added up in two steps, over hash buckets of a source and within a bucket, so a source with a
third of all rows is not one task.

Defined results: a null source is a source of its own; null and empty texts have size 0 and keep their place; sources without
a target weight get the smallest weight; target weights of zero or less count as the smallest. Repeated rows are placed one by one.
Ties in the hash order go by id, then by text. Extra columns are ignored by ``schedule`` and kept by ``mix``. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelattice.llm.common import parts_for
from hirelattice.session import materialise

BLOCK_CHARS = 1 << 14
PERIOD = 1024
BUCKET_DIGITS = 3  # hex digits of the hash: 4,096 buckets per source


def _source(column: Column) -> Column:
    """A text that is never null and differs for all sources."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def _quotas(sizes: DataFrame, weights: DataFrame | None, period: int) -> DataFrame:
    """stream, slots: the slots of a period that each source gets."""
    if weights is None:
        wanted = sizes.select("stream", F.sqrt("size").alias("weight"))
    else:
        given = weights.select(_source(F.col("source")).alias("stream"), F.greatest(F.col("weight"), F.lit(0.0)).alias("weight"))
        wanted = sizes.select("stream").join(given.groupBy("stream").agg(F.max("weight").alias("weight")), "stream", "left")
        wanted = wanted.fillna(0.0, ["weight"])
    total = wanted.agg(F.sum("weight").alias("total"))
    share = F.coalesce(F.col("weight") / F.nullif("total", F.lit(0.0)), F.lit(0.0))
    return wanted.join(F.broadcast(total)).select(  # one row
        "stream", F.greatest(F.lit(1), F.round(share * period)).cast("long").alias("slots")
    )


def period_schedule(quotas: DataFrame) -> DataFrame:
    """stream, turn, slot, slots, period: earliest deadline first over one period.

    A source with one slot may stand anywhere in the period, so those sources are a queue: they take the slots that the others
    leave, in their order. The others, fewer than the period was asked to have slots however many sources there are, become one row; a fold over
    the slots takes the released block with the earliest deadline, the first source on ties. The work grows with the number of sources, not with its square.
    """
    place = (F.row_number().over(Window.orderBy("stream")) - 1).cast("long")  # a row per source
    sources = materialise(quotas.withColumn("at", place), "sources")
    one = sources.agg(
        F.sum("slots").alias("period"),
        F.array_sort(F.collect_list(F.when(F.col("slots") > 1, F.struct("at", "slots")))).alias("several"),
        F.array_sort(F.collect_list(F.when(F.col("slots") == 1, F.col("at")))).alias("queue"),
    )
    taken = one.where("period IS NOT NULL").select("period", F.expr("""
        aggregate(
          sequence(0L, period - 1),
          named_struct('used', transform(several, s -> 0L), 'taken', cast(array() AS array<struct<slot: bigint, i: int>>)),
          (done, slot) -> transform(
            array(array_min(concat(
              filter(
                transform(several, (s, i) -> named_struct(
                  'due', IF(done.used[i] < s.slots AND (done.used[i] * period) div s.slots <= slot,
                            ((done.used[i] + 1) * period + s.slots - 1) div s.slots, NULL),
                  'at', s.at, 'i', i)),
                x -> x.due IS NOT NULL),
              IF(slot - size(done.taken) < size(queue),
                 array(named_struct('due', period, 'at', queue[int(slot - size(done.taken))], 'i', -1)),
                 cast(array() AS array<struct<due: bigint, at: bigint, i: int>>))
            )).i),
            pick -> named_struct(
              'used', IF(pick < 0, done.used, transform(done.used, (u, i) -> IF(i = pick, u + 1, u))),
              'taken', IF(pick < 0, done.taken, concat(done.taken, array(named_struct('slot', slot, 'i', pick))))))[0],
          done -> transform(done.taken, t -> named_struct('slot', t.slot, 'at', several[t.i].at)))
    """).alias("taken"))
    taken = materialise(taken, "period")
    placed = taken.select(F.explode("taken").alias("t")).select("t.slot", "t.at")
    free = taken.select(F.explode(F.expr("sequence(0L, period - 1)")).alias("slot")).join(placed, "slot", "left_anti")
    rank = lambda order: F.row_number().over(Window.orderBy(order))  # noqa: E731  a row per source
    queue = sources.where("slots = 1").select("at", rank("at").alias("rank"))
    placed = placed.unionByName(free.select("slot", rank("slot").alias("rank")).join(queue, "rank").select("slot", "at"))
    turn = F.row_number().over(Window.partitionBy("at").orderBy("slot")) - 1
    named = placed.withColumn("turn", turn.cast("long")).join(sources, "at")
    return named.join(F.broadcast(taken.select("period"))).select("stream", "slots", "period", "slot", "turn")  # one row


def _started(documents: DataFrame) -> DataFrame:
    """doc_id, stream, size, start: the size of the source's documents before each one, in hash order."""
    drawn = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = documents.select(
        "doc_id", "source", _source(F.col("source")).alias("stream"), drawn.alias("drawn"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("t"),
    )
    rows = materialise(rows.withColumn("bucket", F.substring("drawn", 1, BUCKET_DIGITS)), "streams")
    upto = Window.partitionBy("stream").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("stream", "bucket").agg(F.sum("size").alias("held"))
    buckets = buckets.select("stream", "bucket", F.coalesce(F.sum("held").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy("stream", "bucket").orderBy("drawn", "doc_id", "t").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.join(buckets, ["stream", "bucket"]).withColumn("start", start).drop("base", "bucket")


def schedule(
    documents: DataFrame, weights: DataFrame | None = None, block_chars: int = BLOCK_CHARS, period: int = PERIOD,
) -> DataFrame:
    """doc_id, source, size, block, released, due, slot, block_start for every document.

    ``block`` is the source's block in which the document starts, ``slot`` its place in the mix, and ``block_start`` the
    characters of that block before the document.
    """
    started = _started(documents)
    quotas = _quotas(started.groupBy("stream").agg(F.sum("size").alias("size")), weights, period)
    plan = period_schedule(materialise(quotas, "quotas"))
    blocks = started.withColumn("block", F.floor(F.col("start") / block_chars).cast("long"))
    slots = plan.select("stream", "slots", "period").distinct()
    turned = blocks.join(slots, "stream").withColumn("turn", F.col("block") % F.col("slots"))
    placed = turned.join(plan.select("stream", "turn", F.col("slot").alias("in_period")), ["stream", "turn"])
    return placed.select(
        "doc_id", "source", "size", "block", F.expr("(block * period) div slots").alias("released"),
        F.expr("((block + 1) * period + slots - 1) div slots").alias("due"),
        F.expr("(block div slots) * period + in_period").alias("slot"),
        (F.col("start") - F.col("block") * block_chars).alias("block_start"), "t",
    )


def report(documents: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    return schedule(documents, weights).drop("t")


def mix(documents: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """All documents, all columns, in the order of the mix: sorted files, one range of slots each."""
    key = [F.col("doc_id"), _source(F.col("source")), F.md5(F.coalesce("text", F.lit("")))]
    rows = documents.select(F.struct("*").alias("row"), *(k.alias(n) for k, n in zip(key, ("id", "stream", "text_hash"), strict=True)))
    # rows that repeat id, source and text are interchangeable: one place stands for them
    places = schedule(documents, weights).groupBy(
        F.col("doc_id").alias("placed_id"), _source(F.col("source")).alias("placed_stream"), F.col("t").alias("placed_hash")
    ).agg(F.min(F.struct("slot", "block_start")).alias("place"))
    same = (
        F.col("id").eqNullSafe(F.col("placed_id")) & (F.col("stream") == F.col("placed_stream"))
        & (F.col("text_hash") == F.col("placed_hash"))
    )
    ordered = rows.join(places, same).repartitionByRange(parts_for(documents), "place").sortWithinPartitions("place")
    return ordered.select("row.*")


ORACLE = f"""
WITH RECURSIVE rows_of AS (
  SELECT doc_id, source, coalesce(length(text), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS drawn, md5(coalesce(text, '')) AS t
  FROM documents
), started AS (
  SELECT *, coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY drawn, doc_id, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM rows_of
), sizes AS (
  SELECT source, sqrt(sum(size)) AS weight FROM rows_of GROUP BY source
), quotas AS (
  SELECT source, greatest(1, round(weight / sum(weight) OVER () * {PERIOD}))::BIGINT AS slots,
    row_number() OVER (ORDER BY source) AS num
  FROM sizes
), setting AS (
  SELECT list(slots ORDER BY num) AS q, sum(slots)::BIGINT AS period, count(*) AS n FROM quotas
), edf(slot, used, pick) AS (
  SELECT -1::BIGINT, list_transform(q, lambda x: 0::BIGINT), 0::BIGINT FROM setting
  UNION ALL
  SELECT slot + 1, list_transform(range(1, n + 1), lambda i: used[i] + CASE WHEN i = p THEN 1 ELSE 0 END), p
  FROM (
    SELECT slot, used, n, period, list_min(list_transform(range(1, n + 1), lambda i:
      CASE WHEN used[i] < q[i] AND (used[i] * period) // q[i] <= slot + 1
        THEN (((used[i] + 1) * period + q[i] - 1) // q[i]) * 1000000 + i END)) % 1000000 AS p
    FROM edf, setting WHERE slot + 1 < period
  )
), plan AS (
  SELECT pick AS num, slot, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS turn FROM edf WHERE slot >= 0
), blocks AS (
  SELECT s.*, start // {BLOCK_CHARS} AS block, slots, num, period FROM started s JOIN quotas USING (source), setting
)
SELECT doc_id, source, size, block, (block * period) // slots AS released,
  ((block + 1) * period + slots - 1) // slots AS due, (block // slots) * period + slot AS slot,
  start - block * {BLOCK_CHARS} AS block_start
FROM blocks b JOIN plan p ON b.num = p.num AND b.block % b.slots = p.turn
"""
