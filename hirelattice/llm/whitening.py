"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Each component c of a vector becomes the whole number x = floor(64 c) + 1,000,000. The covariance V of the distinct x-vectors is never
built: a block of directions Q is multiplied by it in passes over the data, each task adding up Zᵀ(ZQ) of its centred rows Z,
and only dimensions times directions numbers move. A few Lanczos steps bound the spectrum from below; a Chebyshev polynomial
that is small between that bound and the block's last Ritz value then damps the unwanted directions, one pass a degree. QR and a
Rayleigh-Ritz step follow. It ends when every wanted pair's residual is certified, measured by one more pass, not estimated.

Sums of x are exact whole numbers, and rows are centred on the nearest whole number first, so nothing cancels.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do those with a component of 2^55 and
more in size, whose x is no long, nor those whose length is not the most frequent one (ties: the shorter). A ``deviation`` that is no long is
null. There are as many components as V has positive eigenvalues, 16 at most; with one distinct vector there are none and no rows. Repeated rows
count once in the fit and come out one by one; a null ``vec_id`` stays null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.session import materialise

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 55)
DEGREE = 10
GROWTH = 1e8  # of the first direction over the damped ones in one filter, so that QR keeps the others
TOLERANCE = 1e-13  # of the largest eigenvalue, for residuals
COARSE = 1e-11  # accepted when rounding lets residuals shrink no further
ROUNDS = 200
WHOLE = 1 << 32


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the usable vectors."""
    c = F.col("embedding")
    usable = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    found = vectors.select("vec_id", F.when(usable, x).alias("x")).where("x IS NOT NULL")
    return materialise(found, "whole-vectors")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("x")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def _numbered(prefix: str, values: np.ndarray) -> pa.RecordBatch:
    """A row for each row of a matrix: its number and its values."""
    columns = [pa.array(np.arange(len(values)), pa.int32()), *(pa.array(np.ascontiguousarray(v)) for v in values.T)]
    return pa.RecordBatch.from_arrays(columns, names=["row", *(f"{prefix}{k}" for k in range(values.shape[1]))])


class Centre:
    """Subtracts the mean of the fit list: its nearest whole numbers exactly, then what is left of it."""

    def __init__(self, n: int, sums: list[int]) -> None:
        means = [Fraction(s, n) for s in sums]
        self.base = np.array([round(m) for m in means], np.int64)
        self.rest = np.array([float(m - round(m)) for m in means])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest


@dataclass
class Fit:
    """The distinct x-vectors: how many, their sums, and passes over them."""

    distinct: DataFrame
    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.centre = Centre(self.n, self.sums)

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def total(self, of_rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """A matrix of each batch of centred rows, summed over all."""
        centred = self.centre
        shape = of_rows(np.zeros((0, self.dimensions))).shape

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape)
            for batch in batches:
                if batch.num_rows:
                    out += of_rows(centred(_matrix(batch)))
            yield _numbered("v", out)

        names = [f"v{k}" for k in range(shape[1])]
        parts = self.distinct.mapInArrow(add, "row int, " + ", ".join(f"{v} double" for v in names))
        rows = parts.groupBy("row").agg(*(F.sum(v).alias(v) for v in names)).collect()
        out = np.zeros(shape)
        for r in rows:
            out[r["row"]] = [r[v] for v in names]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V Q by one pass."""
        return self.total(lambda z: z.T @ (z @ q)) / self.n

    def trace(self) -> float:
        return float(self.total(lambda z: np.array([[(z * z).sum()]]))[0, 0]) / self.n


def fit_list(rows: DataFrame) -> Fit | None:
    """The distinct vectors, written, with their number and exact sums."""
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None or lengths["d"] == 0:
        return None
    d = lengths["d"]
    distinct = materialise(rows.where(F.size("x") == d).select("x").distinct(), "distinct-vectors")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * d
        for batch in batches:
            x = _matrix(batch) if batch.num_rows else np.zeros((0, d), np.int64)
            high, low = (x >> 32).sum(axis=0).tolist(), (x & (WHOLE - 1)).sum(axis=0).tolist()  # 2^31 rows a batch fit
            sums = [s + h * WHOLE + v for s, h, v in zip(sums, high, low, strict=True)]
        values = pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), values], names=["row", "s"])

    parts = distinct.mapInArrow(add, "row int, s decimal(38,0)").groupBy("row").agg(F.sum("s").alias("s")).collect()
    sums = [0] * d
    for r in parts:
        sums[r["row"]] = int(r["s"])
    return Fit(distinct, distinct.count(), sums)


# --- the eigenvalue problem ---------------------------------------------------------------


def lower_bound(fit: Fit, steps: int = 10) -> float:
    """A bound below the spectrum: the smallest Ritz value of a few Lanczos steps less the last residual."""
    q = np.random.default_rng(1).standard_normal(fit.dimensions)
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, fit.dimensions)):
        w = fit.times(basis[-1][:, None])[:, 0]
        alphas.append(float(w @ basis[-1]))
        for _ in range(2):  # kept orthogonal by force
            w -= np.array(basis).T @ (np.array(basis) @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * max(alphas):
            break
        basis.append(w / betas[-1])
    inner = betas[:len(alphas) - 1]
    ritz = np.linalg.eigvalsh(np.diag(alphas) + np.diag(inner, 1) + np.diag(inner, -1))
    return max(0.0, float(ritz[0]) - betas[-1])


def chebyshev(fit: Fit, q: np.ndarray, low: float, high: float, first: float) -> np.ndarray:
    """The filter polynomial of V on Q, scaled so that it is about one at ``first``."""
    centre, half = (high + low) / 2, (high - low) / 2
    reach = np.arccosh(max(1 + 1e-9, (first - centre) / half))
    degree = int(np.clip(np.log(2 * GROWTH) / reach, 1, DEGREE))
    sigma = first_sigma = half / (first - centre)
    before, now = q, (fit.times(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        next_sigma = 1 / (2 / first_sigma - sigma)
        before, now = now, (fit.times(now) - centre * now) * (2 * next_sigma / half) - before * (sigma * next_sigma)
        sigma = next_sigma
    return now


def leading(fit: Fit, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors, as columns, certified by their residuals."""
    d = fit.dimensions
    block = min(d, 3 * wanted)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((d, block)))[0]
    low = lower_bound(fit) if block < d else 0.0
    least = np.inf
    for _ in range(ROUNDS):
        w = fit.times(q)
        small = q.T @ w
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        k = min(wanted, block)
        scale = max(values[0], 0.0)
        residual = float(np.linalg.norm(w[:, :k] - q[:, :k] * values[:k], axis=0).max())
        if residual <= TOLERANCE * scale or (residual <= COARSE * scale and residual > least / 2) or block == d:
            keep = values[:k] > COARSE * scale
            vectors = q[:, :k][:, keep]
            signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
            return values[:k][keep], vectors * signs
        least = min(least, residual)
        high = max(float(values[-1]), low + 1e-9 * scale)
        q = np.linalg.qr(chebyshev(fit, q, min(low, high - 1e-9 * scale), high, scale))[0]
    raise ArithmeticError(f"no certificate after {ROUNDS} rounds: residual {least}")


# --- all rows -----------------------------------------------------------------------------


def deviations(x: np.ndarray, fit_n: int, sums: list[int]) -> list[int | None]:
    """Per row the exact sum of (n x - S)^2, null where it is no long."""
    rough = ((fit_n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2).sum(axis=1)
    base = np.array([round(Fraction(s, fit_n)) for s in sums], np.int64)
    rest = [s - fit_n * int(b) for s, b in zip(sums, base, strict=True)]
    exact: list[int | None]
    # centred numbers times n stay below 2^31.5 when the rounded sum of squares stays far below 2^63
    near = (np.abs((x - base).astype(np.float64)) * fit_n).max(initial=0.0)
    if near < 2.0**30 and max(map(abs, rest), default=0) < 2**30 and (rough < 2.0**62).all():
        return (((x - base) * fit_n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((fit_n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = whole_numbers(vectors)
    fit = fit_list(rows)
    values, directions = leading(fit, components) if fit else (np.zeros(0), np.zeros((0, 0)))
    if not len(values):
        return rows.limit(0).selectExpr(
            "vec_id", "1 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error"
        )
    project = directions / np.sqrt(values)
    explained = values / fit.trace()
    moments = fit.total(lambda z: (w := np.column_stack([z @ project, np.ones(len(z))])).T @ w) / fit.n
    means = moments[-1, :-1]
    error = float(np.abs(moments[:-1, :-1] - np.outer(means, means) - np.eye(len(values))).max())
    n, sums, k, centred = fit.n, fit.sums, len(values), fit.centre

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            again = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(again),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, n)),
                pa.array(deviations(x, n, sums), pa.int64()).take(again),
                pa.array((centred(x) @ project).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(x) * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == fit.dimensions).mapInArrow(out, schema)
