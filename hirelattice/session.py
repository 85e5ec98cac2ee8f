"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library relies on. Sizes are left to adaptive
# execution: it coalesces small shuffle partitions, splits skewed ones and turns
# a sort-merge join into a broadcast join only after it has seen the real size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows of numbers and short ids shrink to a twentieth in files and shuffles, so a task of the engine's default
# bytes can hold a gigabyte of them: (setting, its default, ours).
TASK_BYTES = [
    ("spark.sql.files.maxPartitionBytes", 128 << 20, 8 << 20),
    ("spark.sql.adaptive.advisoryPartitionSizeInBytes", 64 << 20, 16 << 20),
]
_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def _bytes(size: str) -> int:
    digits = size.rstrip("bkmgBKMG")
    return int(digits) * _UNITS[size[len(digits):].lower() or "b"]


def bound_tasks(spark: SparkSession) -> None:
    """Cut the tasks of this session small enough for rows that compress well; sizes other than the defaults stay.

    More input then makes more tasks and not larger ones, so aggregates and sorts of any input stay in memory.
    """
    for key, default, ours in TASK_BYTES:
        if _bytes(spark.conf.get(key)) == default:
            spark.conf.set(key, f"{ours}b")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from the session's checkpoint setting.

    Only a local master may fall back to a temporary folder: on a cluster that would
    be one machine's disk, so the job stops instead.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="hirelattice-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written copy cuts the lineage, keeps its values when executors are lost, and
    stays columnar, so later steps read only the columns they need. The shuffles behind it
    are of no more use then, so Spark is told to remove their files with the write.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)
