"""Questions that chunks of a table put to buckets of a key space, in compressed columns of numbers.

A chunk is one row that holds many documents, written to the shared folder, so its number stays the same in every later pass.
It cuts its sorted keys into buckets; the rows of a bucket meet in one task, which answers each of them with one number
a key; the answers go back to the chunks. A chunk asks for a key once, however often it holds it, so a key that stands
everywhere costs a bucket one entry a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.llm.common import parts_for

MASK = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte of their places, compressed."""
    planes = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)
    width = next((w for w in range(8, 1, -1) if planes[:, w - 1].any()), 1)
    return bytes([width]) + zstandard.compress(planes[:, :width].T.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(width, -1)
    planes = np.zeros((raw.shape[1], 8), np.uint8)
    planes[:, :width] = raw.T
    return planes.view("<u8").ravel()


def pack_sorted(numbers: np.ndarray) -> bytes:
    """Ascending unsigned numbers, as their differences."""
    return pack(np.diff(numbers, prepend=np.zeros(1, np.uint64)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_ids(ids: np.ndarray) -> bytes:
    """Signed numbers, by their distance from the least one."""
    least = ids.min()
    return int(least).to_bytes(8, "little", signed=True) + pack(ids.view(np.uint64) - np.array(least).view(np.uint64))


def unpack_ids(data: bytes) -> np.ndarray:
    return (unpack(data[8:]) + np.frombuffer(data[:8], np.uint64)).view(np.int64)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A one-to-one mapping of 64-bit numbers that spreads them evenly."""
    x = numbers + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit hash, from its upper half."""
    return ((hashes >> HALF) * np.uint64(buckets)) >> HALF


def bucket_cuts(sorted_buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket that is there, and where its keys lie."""
    starts = np.flatnonzero(np.diff(sorted_buckets, prepend=np.uint64(1 << 40)))
    for lo, hi in zip(starts, [*starts[1:], len(sorted_buckets)], strict=False):  # no starts if nothing is there
        yield int(sorted_buckets[lo]), slice(int(lo), int(hi))


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts by the keys (the last one counts first), where runs of equal keys begin in it, and each place's run.

    The first key only orders inside the runs.
    """
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys[1:]:
        put = key[order]
        new[1:] |= put[1:] != put[:-1]
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), run


def answers(asked: DataFrame, answer: Callable[[list[dict]], list[tuple[int | None, bytes]]]) -> DataFrame:
    """chunk, bucket, answer for rows with ``bucket`` and ``chunk``; ``answer`` gets a bucket's rows and returns (chunk, answer)."""

    def one(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        given = answer(rows)
        return pa.table({
            "chunk": pa.array([g[0] for g in given], pa.int64()),
            "bucket": pa.array([rows[0]["bucket"]] * len(given), pa.int32()),
            "answer": pa.array([g[1] for g in given], pa.binary()),
        })

    return asked.groupBy("bucket").applyInArrow(one, "chunk long, bucket int, answer binary")


def by_chunk(answered: DataFrame, name: str) -> DataFrame:
    """chunk and its answers, as a list of (bucket, answer)."""
    return answered.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias(name))


def bucket_count(df: DataFrame, load: int | None, share: int) -> int:
    """So many buckets that each gets about ``share`` of the load, and every task of a shuffle one at least."""
    return max(parts_for(df), (load or 0) // share, 1)


def chunk_number(partition: int, turn: int) -> int:
    return (partition << 33) + turn
