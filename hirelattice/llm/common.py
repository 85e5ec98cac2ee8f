"""What the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str) -> Column:
    """Is the document kept out of training? Documents without an id always are."""
    fold = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == 0, F.lit(True))


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = 256, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds few rows and little text, one row at least."""
    for batch in batches:
        values = batch.column(column)
        start = 0
        while start < batch.num_rows:
            end = min(batch.num_rows, start + rows)
            while end - start > 1 and values.slice(start, end - start).nbytes > size:
                end = start + (end - start) // 2
            yield batch.slice(start, end - start)
            start = end


_HELD: dict[tuple, object] = {}


def held(*key, build):
    """What a worker process keeps from task to task: one thing at a time, so an operator's takes the place of the last one's."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def exact_key(*columns: Column) -> tuple[Column, Column]:
    """128 bits that stand for the values: two 64-bit hashes with different seeds."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


def parts_for(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def let_workers_import(spark) -> None:
    """Put this package's folder on the Python path of the workers, for sessions started elsewhere.

    On a cluster whose machines lack the folder, ship the package with ``--py-files``.
    """
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))
