"""CSV folders: discovery, typed reading, writing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)
from pyspark.sql.window import Window

from ..functions import parse_day
from ..functions.dates import strict
from ..session import materialise

# Texts that count as missing, besides the empty one.
MISSING_TEXTS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_LAYOUT = {"header": "true", "quote": '"', "escape": '"'}


def discover(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Sorted (table, path) of every ``*.csv`` in the folder; an empty folder is an error.

    A path may be one file or a folder of part files as Spark writes them.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(folder, "*.csv")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(pattern) or []
    paths = sorted((f.getPath().getName(), f.getPath().toString()) for f in found)
    if not paths:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return [(name.removesuffix(".csv"), path) for name, path in paths]


def _typed(name: str, kind, missing: list[str]) -> Column:
    text = F.col(f"`{name}`")
    text = F.when(~text.isin("", *missing), text)
    if isinstance(kind, StringType):
        return text.alias(name)
    if isinstance(kind, DateType):
        return parse_day(text).alias(name)
    return strict(text, text.try_cast(kind), f"{kind.simpleString()}").alias(name)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, record) of CSV files whose quoted fields may hold line breaks, read in as many tasks as the files have splits.

    A line break ends a record when the quotes before it are even in number. Each split counts its quotes and, for either
    state it may begin in, its record starts; a running sum over the splits of a file (one row each) says which state it is
    and how many records came before. Only the lines of records that go over several lines are put together again.
    Quotes must stand in quoted fields only, doubled inside them. ``number`` counts the records of a file from 0; the lines of
    a split meet in one task, so no task holds more than a split.
    """
    quotes = F.expr("length(value) - length(replace(value, '\"', ''))")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value", (quotes % 2).cast("int").alias("odd"),
    )
    inside = Window.partitionBy("file", "block").orderBy("line")
    odd_before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    states = lines.withColumn("state", odd_before)  # as if the split began outside quotes
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = states.select("*", *(F.sum((F.col("state") == s).cast("bigint")).over(upto).alias(f"starts{s}") for s in (0, 1)))

    splits = counted.groupBy("file", "block").agg(
        F.sum("odd").alias("odds"), F.max("starts0").alias("all0"), F.max("starts1").alias("all1")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.withColumn("begins", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("begins") == 0, F.col("all0")).otherwise(F.col("all1"))
    begins = begins.select("file", "block", "begins", F.coalesce(F.sum(starts).over(earlier), F.lit(0)).alias("before"))

    placed = counted.join(begins, ["file", "block"]).select(
        "file", "block", "line", "value", "odd", (F.col("state") == F.col("begins")).alias("start"),
        (F.col("before") + F.when(F.col("begins") == 0, F.col("starts0")).otherwise(F.col("starts1")) - 1).alias("number"),
    )
    alone = F.col("start") & (F.col("odd") == 0)
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    whole = placed.where(alone).select("file", "number", F.col("value").alias("record"))
    broken = placed.where(~alone).groupBy("file", "number").agg(joined.alias("record"))
    records = whole.unionByName(broken)
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")


def _fields_of_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The records as text columns; a header that is not ``names`` raises, and so does a record with other fields."""
    text = ", ".join(f"`f{i}` string" for i in range(len(names)))
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    fields = csv_records(spark, path).select("number", F.from_csv("record", text, options).alias("r"))
    header = F.array(*(F.col(f"r.f{i}") for i in range(len(names))))
    wrong = (F.col("number") == 0) & ~header.eqNullSafe(F.array(*map(F.lit, names)))
    raised = F.raise_error(F.concat(F.lit("the header is not as the schema has it: "), F.array_join(header, ",", ""))).cast("boolean")
    data = fields.where(F.when(wrong, raised).otherwise(F.col("number") > 0))
    return data.select(*(F.col(f"r.f{i}").alias(name) for i, name in enumerate(names)))


# --- types of files without a schema --------------------------------------------------------

# From narrow to wide; a column takes the widest kind that one of its values needs.
_MISSING, _BOOLEAN, _WHOLE, _DECIMAL, _TEXT = range(5)
_WHOLE_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])\s*$"


def _kind_of(text: Column) -> Column:
    return (
        F.when(text.isNull(), _MISSING).when(text.isin("True", "TRUE", "true", "False", "FALSE", "false"), _BOOLEAN)
        .when(text.rlike(_WHOLE_TEXT) & F.trim(text).try_cast("bigint").isNotNull(), _WHOLE)
        .when(text.rlike(_NUMBER_TEXT), _DECIMAL).otherwise(_TEXT)
    )


def _column_type(least: int, most: int, missing: bool) -> DataType:
    """Whole numbers stay so only where no value is missing; truth values with numbers or gaps are text."""
    if most == _MISSING:
        return DoubleType()  # nothing but gaps
    if most == _BOOLEAN:
        return StringType() if missing else BooleanType()
    if most == _TEXT or least == _BOOLEAN:
        return StringType()
    return LongType() if most == _WHOLE and not missing else DoubleType()


def infer_types(text: DataFrame) -> DataFrame:
    """A frame of texts with the types its values ask for, from one pass: the texts are written while each column's kinds are summed up.

    The summary of a column is its narrowest and widest kind and whether values are missing, so parts of a file can be summed up apart
    and put together. Kinds are truth values, whole numbers, numbers and texts; dates stay text.
    """
    names = text.columns
    numbered = text.toDF(*(f"c{i}" for i in range(len(names))))
    seen = Observation()
    kinds = [(i, _kind_of(F.col(f"c{i}"))) for i in range(len(names))]
    summed = [F.count(F.lit(1)).alias("rows")]
    for i, kind in kinds:
        known = F.when(kind > _MISSING, kind)
        summed += [
            F.coalesce(F.min(known), F.lit(_MISSING)).alias(f"least{i}"), F.coalesce(F.max(known), F.lit(_MISSING)).alias(f"most{i}"),
            F.count_if(kind == _MISSING).alias(f"missing{i}"),
        ]
    written = materialise(numbered.observe(seen, *summed), "csv-texts")
    found = seen.get
    types = [_column_type(found[f"least{i}"], found[f"most{i}"], found[f"missing{i}"] > 0) for i in range(len(names))]
    return written.select(*(
        F.col(f"c{i}").alias(name) if isinstance(kind, StringType) else F.trim(f"c{i}").cast(kind).alias(name)
        for i, (name, kind) in enumerate(zip(names, types))
    ))


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None,
    *, missing: list[str] | None = None, multiline: bool = False,
) -> DataFrame:
    """A header CSV with the given column types.

    The header must name the schema's columns in order and every row must have as many
    fields, else the read fails. Fields are read as text, missing marks become NULL, and
    then typed, so a malformed date or number raises. Without a schema the texts are written once
    and each column takes the narrowest type that all its values have; dates stay text. ``multiline`` admits line breaks inside quotes;
    it costs a shuffle of the lines, so it is off unless the files need it.
    """
    missing = MISSING_TEXTS if missing is None else missing
    reader = spark.read.options(**_LAYOUT, mode="FAILFAST")
    if schema is None:
        names = reader.option("multiLine", "true" if multiline else "false").csv(path).columns
    else:
        names = [f.name for f in schema.fields]
    if multiline:
        text = _fields_of_records(spark, path, names)
    else:
        as_text = StructType([StructField(name, StringType(), True) for name in names])
        text = reader.schema(as_text).option("enforceSchema", "false").csv(path)
    if schema is None:
        return infer_types(text.select(*[_typed(name, StringType(), missing) for name in names]))
    return text.select(*[_typed(f.name, f.dataType, missing) for f in schema.fields])


def stamp_loaded(df: DataFrame, instant: datetime | None = None) -> DataFrame:
    """Add the load instant (UTC), one literal for the whole table."""
    instant = instant or datetime.now(timezone.utc)
    text = instant.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
    return df.withColumn("_loaded_at", F.lit(text).cast(TimestampType()))


def write_csv(df: DataFrame, folder: str, table: str, *, multiline: bool = False) -> str:
    """Write a table as ``<table>.csv`` below the folder, with header, NULL as empty text.

    Blanks around texts are kept. A text with a line break raises unless ``multiline`` says that
    the file will be read so too: the reader cuts files at line breaks otherwise.
    """
    path = f"{folder}/{table}.csv"
    if not multiline:
        broken = F.raise_error(F.lit(f"{table}: a text has a line break; write and read it with multiline=True"))
        texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
        df = df.withColumns({
            t: F.when(F.col(f"`{t}`").rlike("[\\r\\n]"), broken).otherwise(F.col(f"`{t}`")) for t in texts
        })
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(**_LAYOUT, **blanks, emptyValue="").mode("overwrite").csv(path)
    return path
