"""Embedding whitening against a dense eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import types as T

from hirelattice.llm import whitening

from .conftest import table

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def numbers(vectors):
    return np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000


def check(rows, vectors, ids, components=16, close=1e-8):
    """Rows of the operator against exact sums and a dense solution; subspaces of equal eigenvalues are compared as a whole."""
    x = numbers(vectors)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), [int(s) for s in distinct.astype(object).sum(axis=0)]
    z = (distinct - np.array(sums, float) / n)
    values, directions = np.linalg.eigh(z.T @ z / n)
    values, directions = values[::-1], directions[:, ::-1]
    k = min(components, int((values > 1e-10 * values[0]).sum()))
    assert len(rows) == k * len(ids)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    expected = (x - np.array(sums, float) / n) @ directions[:, :k] / np.sqrt(values[:k])
    got = np.array([[by_id[i][c].whitened for c in range(1, k + 1)] for i in ids])
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < close
    for i, row in zip(ids, x.tolist()):
        assert by_id[i][1].deviation == sum((n * v - s) ** 2 for v, s in zip(row, sums))
    assert {r.n for r in rows} == {n}
    explained = [by_id[ids[0]][c].explained for c in range(1, k + 1)]
    assert np.allclose(explained, values[:k] / values.sum(), rtol=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_whitening_of_the_given_embeddings(spark):
    given = table(spark, "embeddings")
    rows = given.select("vec_id", "embedding").orderBy("vec_id").collect()
    out = whitening.whiten(given).collect()
    check(out, [r.embedding for r in rows], [r.vec_id for r in rows])
    whitened = np.array([[r.whitened] for r in sorted(out, key=lambda r: (r.vec_id, r.component))]).reshape(len(rows), 16)
    assert np.abs(whitened.T @ whitened / len(rows) - np.eye(16)).max() < 1e-9  # all rows of it are distinct


@pytest.mark.parametrize("dims", [1, 3, 16, 90])
def test_dimensions_and_copies(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = (rng.standard_normal((200, dims)) * np.linspace(3, 0.2, dims)).tolist()
    vectors += [vectors[0]] * 100  # copies count once
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], VECTORS)
    check(whitening.whiten(df).collect(), vectors, list(range(len(vectors))))


def test_a_strong_first_direction(spark):
    """Eigenvalues far apart: the filter must not drown the small ones."""
    rng = np.random.default_rng(0)
    vectors = (rng.standard_normal((400, 70)) * np.r_[2000.0, 50.0, np.linspace(2, 1, 68)]).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], VECTORS)
    check(whitening.whiten(df).collect(), vectors, list(range(len(vectors))), close=1e-6)


def test_unusable_vectors_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    good = rng.standard_normal((30, 4)).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf")] * 4, [1e300] * 4, [1.0, 2.0], [float(1 << 55)] * 4]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(good)] + [(100 + i, v) for i, v in enumerate(bad)], VECTORS).repartition(4)
    for name in ("x", "row", "v0", "component", "n", "whitened", "s", "d"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    check(whitening.whiten(df).collect(), good, list(range(30)))


def test_nothing_to_whiten(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert out.columns == names and out.count() == 0


def test_rank_below_the_wanted_components(spark):
    rng = np.random.default_rng(4)
    corners = rng.integers(-9, 9, (4, 60))
    vectors = corners.astype(float).tolist()  # four points span three directions
    out = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], VECTORS)).collect()
    check(out, vectors, [0, 1, 2, 3])
    assert max(r.component for r in out) == 3


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (3, [2.0, 1.0]), (3, [2.0, 1.0]), (4, [0.0, 5.0])]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(out) == 10 and {r.n for r in out} == {3}
    assert sum(r.vec_id is None for r in out) == 4


def test_deviations_are_exact_or_null():
    x = np.array([[1 << 40, 5], [3, -(1 << 33)], [1, 2]])
    sums = [int(s) for s in x.sum(axis=0)]
    exact = [sum((3 * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    assert whitening.deviations(x, 3, sums) == [e if e < 1 << 63 else None for e in exact]
    assert None in whitening.deviations(x, 3, sums)
    small = np.array([[1_000_003, 999_990], [1_000_000, 1_000_001]])
    assert whitening.deviations(small, 2, [2_000_003, 1_999_991]) == [9 + 121, 9 + 121]
