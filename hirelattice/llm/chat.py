"""Chat formatting by perspective rotation, in DataFrame operations.

Each speaker of a conversation in turn becomes the assistant: the dialogue is rendered once per speaker, that speaker's turns
as the assistant's, all others as named users, and the mask covers what the assistant says. System turns are
context in every rendering and no speaker.

A rendering is cut into parts of about ``part_chars`` characters, whole turns each, so a conversation of any
length is many rows of bounded size (a longer single turn is a part of its own). Mask spans are given from the start of the
whole rendering. Places in the rendering are running sums, added up over groups of ``GROUP_TURNS`` turns and within a group, so one long
conversation is not one task.

Defined results: turns are ordered by number, a null number first, then by speaker and text; rows that repeat conversation, turn,
role and text count once; a null or blank role speaks as ``unknown``; a null text is empty; the null ``conv_id`` is a
conversation of its own; a conversation without a speaker (system turns only) gives no rows. Markers in
texts and names are defused by a blank after their first character. Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The markers of the rendering.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"
PART_CHARS = 1 << 16
GROUP_TURNS = 256


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotated_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, assistant, turn, rendered, said_at, said: one row per turn and perspective.

    ``said_at`` is where the spoken text starts in the rendered turn, ``said`` its length with the closing marker.
    """
    speaker = F.regexp_replace(_plain(F.trim(F.coalesce("role", F.lit("")))), "[\r\n]", " ")
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(speaker == "", UNKNOWN).otherwise(speaker).alias("speaker"), _plain(F.coalesce("text", F.lit(""))).alias("text"),
    ).distinct()
    assistants = turns.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("speaker").alias("assistant"))
    both = turns.join(assistants.distinct(), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    own = F.col("speaker") == F.col("assistant")
    header = (
        F.when(F.col("speaker") == SYSTEM, F.lit(f"{OPEN}system\n")).when(own, F.lit(f"{OPEN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), F.col("speaker"), F.lit("\n")))
    )
    return both.select(
        "conv_id", "assistant", "turn", "speaker", "text", F.concat(header, "text", F.lit(f"{CLOSE}\n")).alias("rendered"),
        F.char_length(header).cast("long").alias("said_at"),
        F.when(own, F.char_length("text").cast("long") + len(CLOSE)).alias("said"),
    )


def render(conversations: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, assistant, part, start, turns, text, masks: masks as "from-to" spans, comma-joined, ends excluded."""
    turns = rotated_turns(conversations).withColumn("length", F.char_length("rendered").cast("long"))
    turns = turns.withColumn("group", F.floor(F.col("turn") / GROUP_TURNS).cast("long"))
    dialogue = Window.partitionBy("conv_id", "assistant")
    earlier = dialogue.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = turns.groupBy("conv_id", "assistant", "group").agg(F.sum("length").alias("held"))
    groups = groups.select(
        F.col("conv_id").alias("c"), F.col("assistant").alias("a"), F.col("group").alias("g"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("assistant") == F.col("a")) & F.col("group").eqNullSafe(F.col("g"))
    inside = Window.partitionBy("conv_id", "assistant", "group").orderBy("turn", "speaker", "text").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = turns.join(groups, same).withColumn(
        "at", F.col("base") + F.coalesce(F.sum("length").over(inside), F.lit(0))
    )
    said = F.when(F.col("said").isNotNull(), F.concat(
        (F.col("at") + F.col("said_at")).cast("string"), F.lit("-"), (F.col("at") + F.col("said_at") + F.col("said")).cast("string")
    ))
    parts = placed.groupBy("conv_id", "assistant", F.floor(F.col("at") / part_chars).cast("long").alias("part")).agg(
        F.min("at").alias("start"), F.count(F.lit(1)).alias("turns"),
        F.array_sort(F.collect_list(F.struct("at", "rendered", said.alias("mask")))).alias("pieces"),
    )
    return parts.select(
        "conv_id", "assistant", "part", "start", "turns", F.array_join("pieces.rendered", "").alias("text"),
        F.array_join("pieces.mask", ",").alias("masks"),
    )


ORACLE = f"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn,
    CASE WHEN trim(coalesce(role, '')) = '' THEN '{UNKNOWN}' ELSE replace(trim(role), '<|', '< |') END AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations
), both_sides AS (
  SELECT t.*, a.assistant FROM turns t
  JOIN (SELECT DISTINCT conv_id, speaker AS assistant FROM turns WHERE speaker <> '{SYSTEM}') a USING (conv_id)
), headed AS (
  SELECT *, CASE WHEN speaker = '{SYSTEM}' THEN '{OPEN}system' WHEN speaker = assistant THEN '{OPEN}assistant'
    ELSE '{OPEN}user name=' || speaker END || chr(10) AS header
  FROM both_sides
), rendered AS (
  SELECT *, header || text || '{CLOSE}' || chr(10) AS piece FROM headed
), placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, assistant ORDER BY turn, speaker, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM rendered
)
SELECT conv_id, assistant, place // {PART_CHARS} AS part, min(place) AS start, count(*) AS turns,
  string_agg(piece, '' ORDER BY place) AS text,
  coalesce(string_agg((place + length(header))::VARCHAR || '-' || (place + length(header) + length(text) + {len(CLOSE)})::VARCHAR, ','
    ORDER BY place) FILTER (speaker = assistant), '') AS masks
FROM placed GROUP BY conv_id, assistant, place // {PART_CHARS}
"""
