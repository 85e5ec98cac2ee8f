"""Top-k search and near-duplicate vectors against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelattice.llm import near_vectors, topk
from tests.llm.conftest import schema, table
from tests.oracle_compare import connect, difference

VECTOR = schema(vec_id=T.LongType(), embedding=T.ArrayType(T.FloatType()), label=T.IntegerType())


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, non-finite components, zero vectors, ties, repeated rows, other lengths, clashing columns."""
    a, b = [0.5, 0.25, -0.75], [0.5, 0.26, -0.75]
    rows = [
        (0, a, 1), (50, a, 1), (50, a, 1), (1, b, 1), (2, b, 2), (3, None, 1), (4, [0.5, None, 1.0], 1),
        (5, [float("nan"), 0.0, 1.0], 1), (6, [float("inf"), 0.0, 1.0], 1), (7, [0.0, 0.0, 0.0], 1), (8, a, None),
        (9, [0.5, 0.25], 1), (None, a, 1), (100, [], 1), (150, [3e38, 1.0, 1.0], 1), (200, [-0.5, -0.25, 0.75], 1),
    ]
    return spark.createDataFrame(rows, VECTOR).selectExpr("*", "1 AS id", "2 AS weight", "3 AS slot", "4 AS keys", "5 AS score")


def components(linked, ids):
    lowest = dict(zip(range(len(ids)), ids))
    while True:
        new = {i: min([lowest[i], *(lowest[j] for j in np.flatnonzero(linked[i]))]) for i in lowest}
        if new == lowest:
            return [lowest[i] for i in range(len(ids))]
        lowest = new


def test_topk_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = topk.search(table(spark, "embeddings"), F.col("vec_id") % 50 == 0)
    assert difference(found, connect(folder), topk.ORACLE) is None


def test_topk_odd_rows(spark, odd):
    got = {}
    for r in topk.search(odd, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 50, 100, 150, 200}
    # 150 has a component of 3e38: all its scores are too large for a long, but for those against a zero weight there
    assert [x[1:] for x in sorted(got[150])] == [(7, 0), (100, 0)]
    a = np.floor(256 * np.array([0.5, 0.25, -0.75])).astype(int)
    own = int(a @ a)
    assert [x[1:] for x in sorted(got[0])] == [(1, int(a @ np.floor([128, 256 * 0.26, -192]))), (2, own + 2 * 64), (8, own), (50, own), (50, own)]
    assert len(got[50]) == 10  # two rows with this id, both answered
    assert [x[2] for x in sorted(got[100])] == [0] * 5  # an empty vector scores 0, smallest ids win
    assert [x[1] for x in sorted(got[100])] == [0, 1, 2, 7, 8]


@pytest.mark.parametrize("bits", [20, 28, 30, 45, 60, 900])
def test_topk_scores_are_exact_at_any_size(spark, bits):
    """64 components of 2^20 to 2^900: sums that leave 53, 63 and all bits of a machine word."""
    rng = np.random.default_rng(bits)
    vectors = rng.uniform(-1, 1, (120, 64)) * 2.0**bits
    vectors[::3] /= 2.0**bits  # small ones among them: mixed pairs
    vectors[::5, 3:] = 0.0
    kinds = schema(vec_id=T.LongType(), embedding=T.ArrayType(T.DoubleType()))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], kinds)
    whole = [[math.floor(256 * Fraction(x)) for x in v] for v in vectors.tolist()]
    expected = {}
    for q in range(0, 120, 50):
        scores = [(sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in range(120) if c != q]
        expected[q] = sorted(((s, c) for s, c in scores if -(1 << 63) <= s < 1 << 63), key=lambda x: (-x[0], x[1]))[:5]
    found = {q: [] for q in expected}
    for r in topk.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
    assert found == expected


def test_topk_empty(spark, odd):
    assert topk.search(odd.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_many_slots(spark, monkeypatch):
    monkeypatch.setattr(topk, "SLOT_ROWS", 37)
    found = topk.search(table(spark, "embeddings"), F.col("vec_id") % 50 == 0)
    assert difference(found, connect("/root/testdata/sf0.001"), topk.ORACLE) is None


@pytest.fixture(scope="module")
def crowd(spark):
    """Groups of near copies around a few centres, one of them holding a third of the rows, and pairs near the bound."""
    rng = np.random.default_rng(7)
    rows, n = [], 0
    for size in (400, 60, 30, 5, 2, *[1] * 400):
        centre = rng.normal(size=24)
        for _ in range(size):
            x = centre / np.linalg.norm(centre) + rng.normal(size=24) * rng.choice([0.0, 0.01, 0.05, 0.08])
            rows.append((n, [float(v) for v in x.astype(np.float32)], int(rng.integers(0, 2))))
            n += 1
    return rows


def test_near_vectors_against_all_pairs(spark, crowd, monkeypatch):
    monkeypatch.setattr(near_vectors, "CHUNK", 50)  # large buckets are cut into chunks
    x = np.array([r[1] for r in crowd])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in crowd])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r for r in near_vectors.link_vectors(spark.createDataFrame(crowd, VECTOR)).collect()}
    links = linked.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(crowd))])
    assert (found <= links).all()
    assert found.sum() >= 0.97 * links.sum()
    same = np.mean([got[i].component_id == c for i, c in enumerate(components(linked, list(range(len(crowd)))))])
    assert same >= 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_near_vectors_odd_rows(spark, odd):
    got = {}
    for r in near_vectors.link_vectors(odd).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[0] == [(4, 0, True)] and got[1] == [(4, 0, False)]
    assert got[50] == [(4, 0, False)] * 2 and got[None] == [(4, 0, False)]
    for alone in (2, 3, 4, 5, 6, 7, 8, 9, 100, 150, 200):
        assert got[alone] == [(0, alone, True)]
    assert near_vectors.link_vectors(odd.limit(0)).count() == 0
