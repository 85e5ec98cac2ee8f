"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Equal vectors of a label form a class; classes are compared. A class's normalised vector gets, in each of several
tables, a bucket: the quantised values floor((a.v + b) / width) of several random projections together with the
label. Classes that share a bucket are compared by their cosine in double precision. A pair counts in the first table
in which both share a bucket, so that links can be counted where they are found, without a list of all pairs. A
large bucket is cut into chunks, and pairs of chunks are compared as separate groups; of a group's links only the counts and a spanning
forest leave the task.

With 16 tables of 16 projections of width 3, a pair at cosine 0.93 shares a bucket with probability 0.96, at
0.97 with more than 0.999; unrelated vectors do with probability 0.0006 per table.

Defined results: vectors that are null, zero, empty, of null label, or hold null or non-finite components link with
nothing: 0 links, their own component, kept. Vectors of different lengths never link. Rows with equal vectors and
label are linked, repeated ``vec_id`` included; ``n_links`` counts other rows. A null ``vec_id`` is never a component's
smallest id unless all are null, and is not kept. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelattice.llm.common import exact_key, parts_for
from hirelattice.llm.components import connected_components
from hirelattice.session import materialise

THRESHOLD = 0.93
TABLES, PROJECTIONS, WIDTH, SEED = 16, 16, 3.0, 20_240
CHUNK = 512  # classes of a bucket compared at once


def linkable(vector: str, label: str) -> Column:
    return (
        F.col(label).isNotNull() & F.col(vector).isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very large or small components stay in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _buckets(tables: int, projections: int, width: float):
    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, tuple] = {}
        for batch in batches:
            vectors = batch.column("vector")
            cuts = vectors.offsets.to_numpy()
            flat = vectors.values.to_numpy(zero_copy_only=False)
            scope = batch.column("scope").to_numpy().astype(np.uint64)
            keys = np.empty((batch.num_rows, tables), np.int64)
            lengths = np.diff(cuts)
            for size in np.unique(lengths):
                if size not in planes:
                    drawn = np.random.default_rng(SEED + int(size))
                    planes[size] = (
                        drawn.normal(size=(size, tables * projections)), drawn.uniform(0, width, tables * projections),
                        drawn.integers(1, 1 << 62, (tables, projections)).astype(np.uint64) * np.uint64(2) + np.uint64(1),
                    )
                normals, shifts, mixers = planes[size]
                at = np.flatnonzero(lengths == size)
                x = flat[cuts[at][:, None] + np.arange(size)]
                steps = np.floor((_unit(x) @ normals + shifts) / width).astype(np.int64).astype(np.uint64)
                mixed = (steps.reshape(len(at), tables, projections) * mixers).sum(axis=2, dtype=np.uint64)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + scope[at, None]
                mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                keys[at] = (mixed + np.arange(tables, dtype=np.uint64)).view(np.int64)
            offsets = np.arange(0, (batch.num_rows + 1) * tables, tables, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("weight"), vectors, pa.ListArray.from_arrays(offsets, keys.ravel())],
                names=["id", "weight", "vector", "keys"],
            )

    return bucket


def _local_roots(linked: np.ndarray) -> np.ndarray:
    """Per row of a symmetric link matrix the smallest row of its component."""
    roots = np.arange(len(linked))
    while True:
        reach = np.where(linked, roots[None, :], len(linked)).min(axis=1, initial=len(linked))
        lower = np.minimum(roots, reach)
        lower = lower[lower]
        if (lower == roots).all():
            return roots
        roots = lower


def _link_cells(threshold: float):
    def one_cell(rows: list[tuple]) -> list[tuple]:
        ids, sides, tables, weights, vectors, keys = zip(*rows, strict=True)
        x = _unit(np.stack(vectors))
        close = (x @ x.T) >= threshold
        np.fill_diagonal(close, False)
        side = np.array(sides)
        if side.any():  # two chunks: pairs within a chunk belong to that chunk's own cell
            close &= side[:, None] != side[None, :]
        a, b = np.nonzero(close)
        if not len(a):
            return []
        all_keys = np.stack(keys)
        for at in range(0, len(a), 1 << 16):  # a pair counts in the first table whose bucket it shares
            some = slice(at, at + (1 << 16))
            first = (all_keys[a[some]] == all_keys[b[some]]).argmax(axis=1)
            late = first != tables[0]
            close[a[some][late], b[some][late]] = False
        links = close @ np.array(weights, np.int64)
        roots = _local_roots(close)
        return [(ids[i], int(links[i]), ids[roots[i]]) for i in np.flatnonzero(links)]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("cell", "id", "side", "table", "weight")]
                vectors, keys = batch.column("vector"), batch.column("keys")
                cuts, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
                key_cuts, key_flat = keys.offsets.to_numpy(), keys.values.to_numpy(zero_copy_only=False)
                for i, (cell, *rest) in enumerate(zip(*columns, strict=True)):
                    yield cell, (*rest, flat[cuts[i]:cuts[i + 1]], key_flat[key_cuts[i]:key_cuts[i + 1]])

        out: list[tuple] = []
        for _, members in groupby(rows(), key=lambda r: r[0]):
            cell = [m[1] for m in members]
            if len(cell) > 1:
                out += one_cell(cell)
            if len(out) > 4096:
                yield _found(out)
                out = []
        yield _found(out)

    return link


def _found(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([o[n] for o in out], pa.int64()) for n in range(3)], names=["id", "links", "root"]
    )


def link_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, projections: int = PROJECTIONS,
    width: float = WIDTH,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    first, second = exact_key(F.col("label"), F.col("vector"))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.when(linkable("embedding", "label"), F.col("embedding").cast("array<double>")).alias("vector"),
    ).select("vec_id", "label", "vector", F.when(F.col("vector").isNotNull(), first).alias("h1"), second.alias("h2"))
    classes = rows.where("vector IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("weight"),
        F.min("vec_id").alias("smallest"),
    )
    # the written copy fixes the class numbers
    classes = materialise(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    points = classes.select("id", "weight", "vector", F.xxhash64("label", F.size("vector")).alias("scope")).mapInArrow(
        _buckets(tables, projections, width), "id long, weight long, vector array<double>, keys array<long>"
    )
    points = materialise(points, "points")

    placed = points.select("id", F.posexplode("keys").alias("table", "key"))
    shared = placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK)
    mine = F.pmod(F.xxhash64("id"), F.col("chunks"))
    members = (
        placed.join(shared, ["table", "key"]).withColumn("chunks", chunks).withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("id", "table", F.xxhash64("table", "key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
                (F.col("mine") > F.col("other")).cast("int").alias("side"))
    )
    parts = parts_for(vectors)
    cells = members.join(points, "id").repartition(parts, "cell").sortWithinPartitions("cell")
    found = materialise(cells.mapInArrow(_link_cells(threshold), "id long, links long, root long"), "links")

    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("id", "h1", "h2", "weight", "smallest")
        .join(counts, "id", "left").join(linked.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    lowest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = named.join(lowest, "component").select(
        "h1", "h2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
