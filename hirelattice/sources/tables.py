"""Stored tables: namespaces, whole-table replacement, appends.

A stored table is a pointer to its current version. Every replacement writes a version of its own, an ordinary table
beside the pointer, and moves the pointer last, in one change of the catalog. So a reader finds the old rows or the new
ones at any moment, partitioned or not, and a write that fails changes nothing. The version before stays until the next
replacement, for readers that still use it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import BASE_TABLES
from ..session import materialise
from .csv_files import discover, read_csv, stamp_loaded

VERSION, PREVIOUS = "stored.version", "stored.previous"  # properties of a pointer


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create the namespace when it is missing; optionally at a shared location."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    return name


def _versions(spark: SparkSession, table: str) -> tuple[str, str | None] | None:
    """The current version of a stored table and the one before; None when nothing is stored there.

    A plain table, stored by other means, is its own version.
    """
    if not spark.catalog.tableExists(table):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found.get(VERSION, table), found.get(PREVIOUS)


def _write_version(df: DataFrame, table: str, partition_by: Sequence[str], buckets: tuple[int, Sequence[str]] | None = None) -> tuple[str, int]:
    """A new version with the rows of ``df``, counted while they are written, without a second scan."""
    version = f"{table}__v_{uuid.uuid4().hex}"
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by)
    try:
        (writer.bucketBy(buckets[0], *buckets[1]) if buckets else writer).saveAsTable(version)
    except Exception:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    return version, int(written.get["rows"])


def bucket_count(spark: SparkSession, table: str) -> int | None:
    """Into how many buckets a stored table deals its rows; None when it does not, or is not there."""
    found = _versions(spark, table)
    if found is None:
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {found[0]}").where("col_name = 'Num Buckets'").first()
    return None if told is None else int(told["data_type"])


def _point(spark: SparkSession, table: str, version: str, previous: str | None, create: str) -> None:
    kept = f", '{PREVIOUS}' = '{previous}'" if previous else ""
    spark.sql(f"{create} {table} TBLPROPERTIES ('{VERSION}' = '{version}'{kept}) AS SELECT * FROM {version}")


def replace_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), buckets: tuple[int, Sequence[str]] | None = None,
) -> int:
    """Replace rows and schema of a stored table; returns the rows written.

    ``df`` may read the table it replaces. ``partition_by`` lays a table that has grown large out by a
    low-cardinality column, so that filters on it skip files; ``buckets``, a number and columns, deals rows to files by those columns, so that
    aggregates and joins on them need no shuffle. A plain table of that name is taken over: it is
    renamed once, and only in that moment absent, so it must not be partitioned.
    """
    spark = df.sparkSession
    version, rows = _write_version(df, table, partition_by, buckets)
    current, previous = _versions(spark, table) or (None, None)
    if current == table:
        current = f"{table}__v_{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {current}")
    _point(spark, table, version, current, "CREATE OR REPLACE VIEW")
    if previous:
        spark.sql(f"DROP TABLE IF EXISTS {previous}")
    return rows


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), once: Sequence[str] = ()) -> None:
    """Append rows; the first append creates the table.

    With ``once``, the columns that name what is appended (a run id), rows whose name the table already holds are left
    out, so an append that is repeated after a failure leaves one copy. The rows are written to the
    shared folder first, so they are the same in both looks at them; only names move, not the table's rows. Columns in
    ``once`` must not be NULL.
    """
    spark = df.sparkSession
    if _versions(spark, table) is None:
        if once:
            df = materialise(df, "append")
        version, _ = _write_version(df, table, partition_by)
        _point(spark, table, version, None, "CREATE VIEW IF NOT EXISTS")
        if _versions(spark, table)[0] == version:
            return
        spark.sql(f"DROP TABLE IF EXISTS {version}")  # another first append came before this one
    current = _versions(spark, table)[0]
    if once:
        df = materialise(df, "append")
        names = list(once)
        known = spark.table(current).select(*names).join(df.select(*names), names, "left_semi").distinct()
        df = df.join(known, names, "left_anti").select(*df.columns)
    _insert(df, current)


def _insert(df: DataFrame, stored: str, overwrite: bool = False) -> None:
    """Add rows by the names of their columns, laid out as the table is; an insert itself goes by position."""
    columns = df.sparkSession.table(stored).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"{stored} has the columns {columns}, the rows have {df.columns}")
    df.select(*columns).write.insertInto(stored, overwrite=overwrite)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Put the rows of ``df`` in place of all rows in their partitions of a stored table; other partitions stay.

    The columns go by name. The partitions change when the write commits; ``df`` must not read the table.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"  # an insert into a table takes it from the session only
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        _insert(df, _versions(spark, table)[0], overwrite=True)
    finally:
        spark.conf.set(mode, before)


def read_namespace(spark: SparkSession, namespace: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The base tables of a namespace by name. A missing table is an error."""
    return {name: spark.table(f"{namespace}.{name}") for name in (tables or list(BASE_TABLES))}


def load_folder(spark: SparkSession, folder: str, namespace: str, schemas=None, **csv) -> DataFrame:
    """Load every CSV of a folder into its table, replacing it; returns (table, rows).

    Tables are replaced one by one in name order, as parallel jobs inside. Loading again
    gives the same rows.
    """
    schemas = BASE_TABLES if schemas is None else schemas
    create_namespace(spark, namespace)
    report = []
    for table, path in discover(spark, folder):
        frame = stamp_loaded(read_csv(spark, path, schemas.get(table), **csv))
        report.append((f"{namespace}.{table}", replace_table(frame, f"{namespace}.{table}")))
    return spark.createDataFrame(report, "table string, rows bigint")
