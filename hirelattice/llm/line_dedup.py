"""Line dedup with a deletion-neighbourhood join, in DataFrame operations only.

Lines are compared without blanks at their ends. A line that is not blank goes when an equal line stands earlier, whatever its length
(``min_exact``); one of at least ``min_chars`` also goes when an earlier line of that length is within one edit (a
character replaced, inserted or left out). Lines are ordered by document id, then by place.

1. Equal lines collapse to one row by a 128-bit hash; the earliest place stays with it.
2. Two different lines within one edit share the half before or the half behind the edit. Lines without a partner by
   either half cannot be within one edit of another and leave here; this loses no pair.
3. The others emit their neighbourhood: the line itself and every variant with one character left out, as hashed keys. A
   variant's key is put together from hashes of 64-character blocks, so a long line costs time in proportion to its length.
4. Equal variants join. Lines that agree after leaving out the same place are all within one edit of each other, so each
   is paired with the earliest only; a whole line is paired with the lines of which it is a variant. No group of variants is
   expanded into all its pairs.
5. The edit distance of each pair is verified on the texts. The later line goes, and with it all its copies.

Texts are cut into lines twice: once for the numbers of every line, which are written, and once for the texts of partnered lines.
A place is one number (document id times 2^31 plus line), so all aggregates over lines are of fixed width.

Defined results: a null text stays null; an empty text has one empty line; a document that loses all its lines keeps an
empty text. A null ``doc_id`` comes last in the order. Equal lines of rows with one id are at the same place: none removes the
other. All columns of the input are kept as they are, but for ``text``; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelattice.llm.common import exact_key, parts_for
from hirelattice.session import materialise

BLANKS = " \t\r\x0b\x0c"
MIN_CHARS = 10
BLOCK = 64  # characters hashed as one
LAST = (1 << 63) - 1
HALVES = ["front", "back", "front_of_longer", "back_of_longer"]
#: Up to so many partnered lines (16 bytes each), and shared halves (8 bytes), are looked up by broadcast; beyond, by a shuffled join.
BROADCAST_LINES = 100_000


def _place(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def _lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """place, t (a hash of the text), line_no, line, h1, h2 of every line long enough."""
    # the text is hashed below the explosion, once a document and not once a line
    places = documents.select(_place(F.col("doc_id")).alias("place"), F.xxhash64("text").alias("t"), "text")
    exploded = places.select("place", "t", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    blank_ends = [side(F.col("raw"), F.lit(b)) for b in BLANKS for side in (F.startswith, F.endswith)]
    line = F.when(reduce(or_, blank_ends), F.btrim("raw", F.lit(BLANKS))).otherwise(F.col("raw"))
    first, second = exact_key(F.col("line"))
    return (
        exploded.select("place", "t", "line_no", line.alias("line"))
        .where(F.char_length("line") >= min_chars).select("*", first.alias("h1"), second.alias("h2"))
    )


def _at(place: Column, line_no: Column) -> Column:
    """A line's place as one number."""
    return (place.cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + line_no).cast("decimal(38,0)")


def _half_keys(line: Column, size: Column) -> list[Column]:
    """Keys that two lines share if they are within one edit; the longer one's length says where the halves end."""

    def halves(longer: Column) -> list[Column]:
        half = F.floor(longer / 2).cast("int")
        return [
            F.xxhash64(longer, F.lit("front"), F.substr(line, F.lit(1), half)),
            F.xxhash64(longer, F.lit("back"), F.substr(line, size - half + 1, half)),
        ]

    return [*halves(size), *halves(size + 1)]


def _partnered(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All different lines with their earliest place, and the hashes of those that share a half with another."""
    kinds = lines.groupBy("h1", "h2").agg(
        F.min(_at(F.col("place"), F.col("line_no"))).alias("first"), F.count(F.lit(1)).alias("copies"), *(F.min(k).alias(k) for k in HALVES)
    )
    kinds = materialise(kinds, "lines")
    # lines too short for the near match have no halves; a line has none of its halves twice
    keyed = kinds.where(F.col(HALVES[0]).isNotNull()).select("h1", "h2", F.explode(F.array(*HALVES)).alias("half"))
    shared = keyed.groupBy("half").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("half")
    shared = materialise(shared, "shared-halves")
    few = shared.count() <= BROADCAST_LINES
    partners = keyed.join(F.broadcast(shared) if few else shared, "half", "left_semi").select("h1", "h2").distinct()
    return kinds, materialise(partners, "partners")


def _variants(candidates: DataFrame) -> DataFrame:
    """h1, h2, first, left_out, variant: the line (left_out null) and all its variants, hashed with their lengths."""
    whole = Window.partitionBy("h1", "h2")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def hashed(text: Column) -> Column:
        return F.when(F.char_length(text) > 0, F.xxhash64("block", text)).otherwise(F.lit(0).cast("long"))

    # few bytes, but each becomes a row: dealt over all tasks, not over as many as the bytes ask for
    blocks = candidates.repartition(parts_for(candidates), "h1", "h2").select(
        "h1", "h2", "first", F.char_length("line").alias("size"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.char_length("line") - 1) / BLOCK).cast("int")),
                lambda b: F.substr(F.col("line"), b * BLOCK + 1, F.lit(BLOCK + 1)),  # one character more than the block
            )
        ).alias("block", "chars"),
    )
    parts = blocks.withColumn("same", hashed(F.substr("chars", F.lit(1), F.lit(BLOCK)))).withColumn(
        "moved", hashed(F.substr("chars", F.lit(2), F.lit(BLOCK)))
    )
    none = F.lit(0).cast("long")
    parts = parts.select(
        "*", F.bit_xor("same").over(whole).alias("all_same"), F.coalesce(F.bit_xor("same").over(before), none).alias("front"),
        F.bit_xor("moved").over(whole).bitwiseXOR(F.bit_xor("moved").over(upto)).alias("behind"),
    )
    own = F.least(F.char_length("chars"), F.lit(BLOCK))
    shorter = parts.select("*", F.explode(F.sequence(F.lit(1), own)).alias("at")).select(
        "h1", "h2", "first", (F.col("block") * BLOCK + F.col("at") - 1).alias("left_out"),
        F.xxhash64(
            F.col("size") - 1,
            F.col("front").bitwiseXOR(F.col("behind")).bitwiseXOR(
                hashed(F.concat(F.substr("chars", F.lit(1), F.col("at") - 1), F.substr("chars", F.col("at") + 1)))
            ),
        ).alias("variant"),
    )
    itself = parts.where("block = 0").select(
        "h1", "h2", "first", F.lit(None).cast("int").alias("left_out"), F.xxhash64("size", "all_same").alias("variant")
    )
    return shorter.unionByName(itself)


def _near_pairs(variants: DataFrame) -> DataFrame:
    """(a, h1, h2): the place of an earlier line and the hashes of a later one that meet in a variant."""
    cut = variants.where("left_out IS NOT NULL").select("variant", "left_out", "first", "h1", "h2")
    earliest = cut.groupBy("variant", "left_out").agg(F.min("first").alias("a"), F.max("first").alias("z")).where("a < z")
    replaced = cut.join(earliest, ["variant", "left_out"]).where("first > a").select("a", "h1", "h2")
    whole = variants.where("left_out IS NULL").select(
        "variant", F.col("first").alias("other"), F.col("h1").alias("o1"), F.col("h2").alias("o2")
    )
    met = cut.join(whole, "variant")
    inserted = met.where("first < other").select(F.col("first").alias("a"), F.col("o1").alias("h1"), F.col("o2").alias("h2"))
    left_out = met.where("first > other").select(F.col("other").alias("a"), "h1", "h2")
    return replaced.unionByName(inserted).unionByName(left_out).distinct()


def dropped_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_exact: int = 1) -> DataFrame:
    """place, t, gone: per document (its place in the order and text hash) the numbers of the lines to remove."""
    texts = _lines(documents, max(1, min(min_exact, min_chars)))
    size = F.char_length("line")
    halves = [F.when(size >= min_chars, k).alias(n) for k, n in zip(_half_keys(F.col("line"), size), HALVES, strict=True)]
    lines = materialise(texts.select("place", "t", "line_no", "h1", "h2", *halves), "line-numbers")
    kinds, partners = _partnered(lines)
    few = partners.count() <= BROADCAST_LINES
    found = (
        texts.where(size >= min_chars).select("h1", "h2", "line")
        .join(F.broadcast(partners) if few else partners, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    )
    candidates = materialise(found.join(kinds.select("h1", "h2", "first"), ["h1", "h2"]), "partnered-lines")

    pairs = materialise(_near_pairs(_variants(candidates)), "line-pairs")
    verified = (
        pairs.join(candidates.select("h1", "h2", F.col("line").alias("later")), ["h1", "h2"])
        .join(candidates.select(F.col("first").alias("a"), F.col("line").alias("earlier")), "a")
        .where(F.levenshtein("earlier", "later", 1) >= 0)
    )
    near = verified.select("h1", "h2", F.lit(True).alias("near")).distinct()
    marked = (
        kinds.select("h1", "h2", "first", "copies").join(near, ["h1", "h2"], "left")
        .where("copies > 1 OR near").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    )
    here = _at(F.col("place"), F.col("line_no"))
    gone = lines.select("place", "t", "line_no", "h1", "h2").join(marked, ["h1", "h2"]).where(F.col("near") | (here > F.col("first")))
    return gone.groupBy("place", "t").agg(F.collect_set("line_no").alias("gone"))


def cleaned(documents: DataFrame, min_chars: int = MIN_CHARS, min_exact: int = 1) -> DataFrame:
    """row (the document as a struct), text (without the removed lines), n_lines and n_removed for every document."""
    gone = dropped_lines(documents, min_chars, min_exact)
    rows = documents.select(F.struct("*").alias("row"), _place(F.col("doc_id")).alias("place"), F.xxhash64("text").alias("t"))
    lines = F.split(F.col("row")["text"], "\n")
    joined = rows.join(gone, ["place", "t"], "left").withColumn("lines", lines)
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.array_join(F.transform(kept, lambda i: F.element_at(F.col("lines"), i + 1)), "\n")
    return joined.select(
        "row", F.when(F.col("gone").isNull(), F.col("row")["text"]).otherwise(text).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
    )


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents, all columns as they were but for ``text``."""
    done = cleaned(documents, min_chars)
    return done.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in documents.columns))


def report(documents: DataFrame, min_chars: int = MIN_CHARS, min_exact: int = 1) -> DataFrame:
    """doc_id, n_lines, n_removed, text for every document."""
    done = cleaned(documents.select("doc_id", "text"), min_chars, min_exact)
    return done.select(F.col("row")["doc_id"].alias("doc_id"), "n_lines", "n_removed", "text")


def removal_sql(table: str, min_chars: int = MIN_CHARS, min_exact: int = 1) -> str:
    """Common table expressions, ending in ``cleaned`` (doc_id, n_lines, n_removed, text)."""
    least = max(1, min(min_exact, min_chars))
    blanks = "chr(32) || chr(9) || chr(13) || chr(11) || chr(12)"
    return f"""
raw_lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, unnest(string_split(text, chr(10))) AS raw
  FROM {table} WHERE text IS NOT NULL
), all_lines AS (
  SELECT *, trim(raw, {blanks}) AS line FROM raw_lines
), kinds AS (
  SELECT line, length(line) AS size, min((doc_id, line_no)) AS first FROM all_lines
  WHERE length(line) >= {least} GROUP BY line
), halves AS (
  SELECT line, size, first, unnest([size, size, size + 1, size + 1]) AS longer,
    unnest(['front' || left(line, size // 2), 'back' || right(line, size // 2),
            'front' || left(line, (size + 1) // 2), 'back' || right(line, (size + 1) // 2)]) AS half
  FROM kinds WHERE size >= {min_chars}
), near AS (
  SELECT DISTINCT b.line FROM halves a JOIN halves b USING (longer, half)
  WHERE a.first < b.first AND a.line <> b.line AND abs(a.size - b.size) <= 1
    AND len(list_filter(range(0, greatest(a.size, b.size)), lambda i:
      left(a.line, i) = left(b.line, i)
      AND right(a.line, (a.size - i - CASE WHEN a.size >= b.size THEN 1 ELSE 0 END)::BIGINT)
        = right(b.line, (b.size - i - CASE WHEN b.size >= a.size THEN 1 ELSE 0 END)::BIGINT))) > 0
), judged AS (
  SELECT l.doc_id, l.line_no, l.raw,
    k.line IS NOT NULL AND (n.line IS NOT NULL OR (l.doc_id, l.line_no) > k.first) AS gone
  FROM all_lines l LEFT JOIN kinds k ON l.line = k.line LEFT JOIN near n ON l.line = n.line
), cleaned AS (
  SELECT doc_id, count(*)::INTEGER AS n_lines, count(*) FILTER (gone)::INTEGER AS n_removed,
    coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text
  FROM judged GROUP BY doc_id
  UNION ALL SELECT doc_id, 0, 0, NULL FROM {table} WHERE text IS NULL
)"""


ORACLE = f"WITH {removal_sql('documents')} SELECT doc_id, n_lines, n_removed, text FROM cleaned"
