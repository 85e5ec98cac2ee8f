"""Exact top-k search by term-at-a-time accumulation.

Vectors become sparse rows of integer weights: floor(256 * x) per component, zeros left out. Scores are exact: where the largest
weights of a query and a candidate could take their sum out of 64 bits, that pair is added up in integers of any size. Candidates are
dealt evenly into slots of bounded size, and every query row visits every slot. In a slot, a component's candidates
and weights form its posting list; a query row scatters, term by term, its weight times the postings into a dense score array,
whose best k entries are selected by partition. The best of each slot are merged per query.

Defined results: vectors that are null or hold null or non-finite components take no part, neither as query nor as
candidate. A pair whose score is no long is left out. A shorter vector's missing components
count as zero, so an empty vector scores 0 against all. A query's own row is no candidate, other rows with its
``vec_id`` are. Every query row is answered, repeated ones too; a null ``vec_id`` is a candidate that loses
ties and no query. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelattice.llm.common import parts_for
from hirelattice.session import materialise

SCALE = 256
LARGE = 2.0**62  # below it a bound of a sum leaves room for rounding
SLOT_ROWS = 32_768  # candidates that one task holds as postings
NO_ID = (1 << 63) - 1


def usable(vector: str) -> Column:
    """No nulls, finite components only."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )


def weights(vector: np.ndarray) -> tuple[np.ndarray, float]:
    """Whole weights in 64 bits (0 for those that are larger), and the largest one's size."""
    with np.errstate(over="ignore"):
        whole = np.floor(SCALE * vector)
    large = np.abs(whole) >= LARGE
    return np.where(large, 0.0, whole).astype(np.int64), float(np.abs(whole).max(initial=0.0))


def exact_score(query: np.ndarray, candidate: np.ndarray) -> int:
    """The score in integers of any size."""

    def whole(vector: np.ndarray) -> list[int]:
        return [math.floor(SCALE * Fraction(x)) for x in vector.tolist()]

    return sum(a * b for a, b in zip(whole(query), whole(candidate), strict=False))


class Postings:
    """The candidates of one slot by component."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: list[np.ndarray]) -> None:
        order = np.argsort(ids, kind="stable")  # equal scores go to the smaller id
        self.rows, self.ids = rows[order], ids[order]
        self.vectors = [vectors[i] for i in order]
        weighed = [weights(v) for v in self.vectors]
        self.largest = np.array([size for _, size in weighed], float)
        lengths = np.fromiter(map(len, self.vectors), np.int64, len(order))
        terms = np.concatenate([np.zeros(0, np.int64), *(np.arange(n) for n in lengths)])
        values = np.concatenate([np.zeros(0, np.int64), *(w for w, _ in weighed)])
        at = np.repeat(np.arange(len(order)), lengths)
        keep = values != 0
        terms, values, at = terms[keep], values[keep], at[keep]
        by_term = np.argsort(terms, kind="stable")
        cuts = np.searchsorted(terms[by_term], np.arange(int(lengths.max(initial=0)) + 1))
        self.lists = [(at[by_term[a:b]], values[by_term[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.place = {int(r): i for i, r in enumerate(self.rows)}

    def scores(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of every candidate, and which of them are longs."""
        weighed, largest = weights(query)
        scores, fits = np.zeros(len(self.ids), np.int64), np.ones(len(self.ids), bool)
        for term in np.flatnonzero(weighed[:len(self.lists)]):
            at, weight = self.lists[term]
            scores[at] += weighed[term] * weight
        with np.errstate(over="ignore", invalid="ignore"):
            in_range = self.largest * largest * max(1, len(query)) < LARGE
        for i in np.flatnonzero(~in_range):
            score = exact_score(query, self.vectors[i])
            fits[i] = -(1 << 63) <= score < 1 << 63
            scores[i] = score if fits[i] else 0
        return scores, fits

    def top(self, row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the best k candidates, the query's own row left out."""
        scores, taken = self.scores(query)
        if row in self.place:
            taken[self.place[row]] = False
        if taken.all():
            others = np.arange(len(scores))
        else:
            others = np.flatnonzero(taken)
            scores = scores[others]
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            best = np.concatenate([np.flatnonzero(scores > least), np.flatnonzero(scores == least)])[:k]
        else:
            best = np.arange(len(scores))
        return others[best], scores[best]


def _answer(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come slot by slot, a slot's candidates before its queries."""
        slot, held, postings = None, [], None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("slot", "is_query", "row", "vec_id")]
            vectors = batch.column("vector")
            cuts, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
            for i, (at, is_query, row, vec_id) in enumerate(zip(*columns, strict=True)):
                vector = flat[cuts[i]:cuts[i + 1]]
                if at != slot:
                    slot, held, postings = at, [], None
                if not is_query:
                    held.append((row, NO_ID if vec_id is None else vec_id, vector.copy()))
                    continue
                if postings is None:
                    rows, ids, kept = zip(*held, strict=True) if held else ((), (), ())
                    postings, held = Postings(np.array(rows, np.int64), np.array(ids, np.int64), list(kept)), []
                places, scores = postings.top(row, vector, k)
                out += [(row, vec_id, int(postings.ids[p]), int(s)) for p, s in zip(places, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[n] for o in out], pa.int64()) for n in range(4)], names=["row", "query_id", "vec_id", "score"]
            )

    return search


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every query row."""
    taken = vectors.where(usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    # the written copy fixes the row numbers
    rows = materialise(taken.withColumn("row", F.monotonically_increasing_id()), "vectors")
    count = rows.count()
    slots = max(1, -(-count // SLOT_ROWS), min(parts_for(vectors), count // 1024))
    candidates = rows.withColumn("is_query", F.lit(False)).withColumn("slot", F.pmod(F.xxhash64("row"), F.lit(slots)))
    queries = rows.where("is_query").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    dealt = candidates.unionByName(queries).repartition(slots, "slot").sortWithinPartitions("slot", "is_query")
    found = dealt.mapInArrow(_answer(k), "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


ORACLE = f"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::HUGEINT) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])), 0) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
  FROM scored WHERE score BETWEEN -9223372036854775808 AND 9223372036854775807
)
SELECT query_id, rank, vec_id, score::BIGINT AS score FROM ranked WHERE rank <= 5
"""
