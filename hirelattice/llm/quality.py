"""A quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation estimates from
the votes alone how often each labeller says what about good and bad documents; it works on the counts of vote
patterns over all documents, of which there are at most 3 to the number of labellers. The posterior of its pattern is a
document's soft label. On a bounded sample of documents these labels train a linear scorer over hashed words
and word shapes, which then scores every whole text.

Defined results: a null text is empty; a text without words has no features, and its score is its posterior. Texts of any length
vote and are scored whole. A null ``doc_id`` stays null. Repeated rows are scored one by one, and count once in the sample, so that
copies cannot swell it. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.llm.common import slices

GOOD, BAD, NOTHING = "+", "-", "0"
BITS = 16  # of a feature's hash
SAMPLE = 8_000  # documents that train the scorer, about
CACHED_WORDS = 250_000  # bounds the memory of a worker, not the result

_SYMBOLS = np.frombuffer(b"#$%&*|<>{}[]=_~^\\@+`", np.uint8)
_DOUBLED = [c * 2 for c in (b"!", b"?", b"#", b"$", b"%", b"&", b"*", b"=", b"_")]
_LONE = (b"|", b"-", b"*", b"&", b"#", b"/")
LABELLERS = ("symbols", "capitals", "variety", "repeated lines", "sentence ends", "doubled marks", "lone marks", "digits", "length")


def _vote(bad: bool, good: bool) -> str:
    return BAD if bad else GOOD if good else NOTHING


def votes(text: bytes | None) -> str:
    """One character per labeller, in the order of ``LABELLERS``. A short text gets few votes."""
    text = text or b""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return NOTHING * (len(LABELLERS) - 1) + BAD
    found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip()]
    upper, lower = found[65:91].sum(), found[97:123].sum() + found[128:].sum() / 2
    variety = len(set(words)) / n
    fresh = len(set(lines)) / max(1, len(lines))
    ends = found[[33, 46, 63]].sum() / n
    doubled = sum(map(text.count, _DOUBLED)) / n
    long = n >= 20
    return "".join((
        _vote(found[_SYMBOLS].sum() > 0.02 * size, long),
        _vote(upper > 0.4 * (upper + lower), long),
        _vote(long and variety < 0.35, long and variety > 0.55),
        _vote(len(lines) > 2 and fresh < 0.5, len(lines) > 2 and fresh > 0.9),
        _vote(ends > 0.6 or n >= 40 and ends < 0.005, 0.02 < ends < 0.35),
        _vote(doubled > 0.1, doubled < 0.01),
        _vote(sum(map(words.count, _LONE)) > 0.2 * n, long),
        _vote(found[48:58].sum() > 0.25 * size, long),
        _vote(n < 3, long),
    ))


def pattern_counts(documents: DataFrame) -> dict[str, int]:
    """How many documents have each vote pattern."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in slices(batches, "text"):
            seen.update(map(votes, batch.column("text").to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["votes", "n"])

    counted = documents.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "votes string, n long")
    return {row[0]: row[1] for row in counted.groupBy("votes").agg(F.sum("n")).collect()}


def posteriors(counts: dict[str, int], rounds: int = 50) -> dict[str, float]:
    """Per vote pattern the probability of a good document, by expectation-maximisation.

    A labeller that says nothing about a pattern says nothing about its class. The start takes any vote for bad as a sign
    of a bad document, as these labellers look for marks that good texts rarely have.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    outcome = np.array([[(GOOD, BAD, NOTHING).index(v) for v in p] for p in patterns])
    n = np.array([counts[p] for p in patterns], float)
    good = np.where((outcome == 1).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        weight = np.stack([good * n, (1 - good) * n])
        log = np.log((weight.sum(axis=1) + 1) / (n.sum() + 2))[:, None].repeat(len(patterns), axis=1)
        for votes_of in outcome.T:
            said = np.stack([weight[:, votes_of == k].sum(axis=1) for k in range(2)], axis=1)
            said += np.array([[2.0, 0.5], [0.5, 2.0]])  # a labeller is taken to be right rather than wrong
            table = np.hstack([said / said.sum(axis=1, keepdims=True), np.ones((2, 1))])
            log += np.log(table[:, votes_of])
        good = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
    return dict(zip(patterns, map(float, good), strict=True))


_SHAPES = [(re.compile(p), s) for p, s in ((rb"[A-Z]+", b"A"), (rb"[a-z\x80-\xff]+", b"a"), (rb"[0-9]+", b"9"))]


def features(word: bytes) -> tuple[int, int]:
    """Hashes of the word and of its shape: runs of capitals, small letters and digits shortened to one."""
    shape = word
    for runs, sign in _SHAPES:
        shape = runs.sub(sign, shape)
    mask = (1 << BITS) - 1
    return zlib.crc32(word) & mask, zlib.crc32(b"shape " + shape) & mask


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def word(self, word: bytes) -> float:
        a, b = features(word)
        return float(self.weights[a] + self.weights[b])


class _WordScores(dict):
    def __init__(self, scorer: Scorer) -> None:
        super().__init__()
        self.scorer = scorer

    def __missing__(self, word: bytes) -> float:
        value = self[word] = self.scorer.word(word)
        return value


def _fit(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 120) -> Scorer:
    """Logistic regression on soft labels: whole-batch steps with per-weight rates, features averaged over a text's words."""
    size = 1 << BITS
    at = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
    values = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    wanted = np.array([r[2] for r in rows])
    weights, bias, mean, spread, bias_mean, bias_spread = np.zeros(size), 0.0, np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, rounds + 1 if rows else 1):
        z = np.bincount(row, values * weights[at], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - wanted) / len(rows)
        slope = np.bincount(at, values * error[row], size) + 1e-7 * weights
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope ** 2
        bias_mean, bias_spread = 0.9 * bias_mean + 0.1 * error.sum(), 0.99 * bias_spread + 0.01 * error.sum() ** 2
        rate = 0.3 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
        weights = weights - rate * mean / (np.sqrt(spread) + 1e-9)
        bias -= rate * bias_mean / (np.sqrt(bias_spread) + 1e-9)
    return Scorer(weights, bias)


def train(documents: DataFrame, by_pattern: dict[str, float], sample: int = SAMPLE) -> Scorer:
    """Fit the scorer in one task on about ``sample`` documents: a fixed set of hash values of text and id, repeated rows once."""
    total = documents.count()
    steps = 1 << 30
    share = min(1.0, sample / max(1, total))
    drawn = documents.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(steps)) < share * steps).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            at, values, goals = [], [], []
            for text in batch.column("text").to_pylist():
                words = (text or b"").split()
                if words:
                    seen = Counter(f for w in words for f in features(w))
                    at.append(list(seen.keys()))
                    values.append([v / len(words) for v in seen.values()])
                    goals.append(by_pattern[votes(text)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64())), pa.array(goals, pa.float64())],
                names=["at", "values", "goal"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("at", "values", "goal"))
            rows += [(np.array(a, np.int64), np.array(v), g) for a, v, g in zip(*columns, strict=True)]
        rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))  # the sums do not depend on the tasks
        scorer = _fit(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([scorer.weights.tobytes()], pa.binary()), pa.array([scorer.bias])], names=["weights", "bias"]
        )

    counted = drawn.select(F.col("text").cast("binary").alias("text")).mapInArrow(
        count, "at array<int>, values array<double>, goal double"
    )
    row = counted.repartition(1).mapInArrow(fit, "weights binary, bias double").collect()
    return Scorer(np.frombuffer(bytes(row[0][0])), row[0][1]) if row else Scorer(np.zeros(1 << BITS), 0.0)


def classify(documents: DataFrame, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """doc_id, votes, p_good, score, kept for every document: score is the scorer's, kept means ``threshold`` or more."""
    by_pattern = posteriors(pattern_counts(documents))
    scorer = train(documents, by_pattern, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordScores(scorer)
        for batch in slices(batches, "text"):
            if len(known) > CACHED_WORDS:
                known = _WordScores(scorer)
            patterns, scores = [], []
            for text in batch.column("text").to_pylist():
                patterns.append(votes(text))
                words = (text or b"").split()
                z = sum(map(known.__getitem__, words)) / len(words) + scorer.bias if words else 0.0
                scores.append(1 / (1 + float(np.exp(-np.clip(z, -50, 50)))) if words else by_pattern[patterns[-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(patterns, pa.string()), pa.array([by_pattern[p] for p in patterns], pa.float64()),
                 pa.array(scores, pa.float64()), pa.array([s >= threshold for s in scores], pa.bool_())],
                names=["doc_id", "votes", "p_good", "score", "kept"],
            )

    source = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(score, f"doc_id {kind}, votes string, p_good double, score double, kept boolean")
