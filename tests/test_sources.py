"""CSV folders and stored tables."""

import random

import pandas
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelattice.schemas import BASE_TABLES
from hirelattice.session import fresh_folder, shared_folder
from hirelattice.sources import csv_files, tables

from .conftest import collected, day


@pytest.fixture
def folder(tmp_path):
    return tmp_path


def test_csv_with_quotes_commas_and_missing_values(spark, folder):
    (folder / "clients.csv").write_text(
        "client_id,company_name,industry,country,signed_at\n"
        'c_001,"Acme, Inc.","The ""Best""",NA,2025-01-31\n'
        "c_002,,SaaS,null,\n"
    )
    df = csv_files.read_csv(spark, str(folder / "clients.csv"), BASE_TABLES["clients"])
    assert df.schema == BASE_TABLES["clients"]
    assert collected(df) == [
        ("c_001", "Acme, Inc.", 'The "Best"', None, day("2025-01-31")), ("c_002", None, "SaaS", None, None)
    ]
    kept = csv_files.read_csv(spark, str(folder / "clients.csv"), BASE_TABLES["clients"], missing=[])
    assert [r.country for r in kept.collect()] == ["NA", "null"]


@pytest.mark.parametrize(
    "body",
    [
        "client_id,company_name,industry,country,signed_at\nc,a,b,d,31.01.2025\n",  # malformed date
        "client_id,company_name,industry,country\nc,a,b,d\n",  # missing column
        "client_id,industry,company_name,country,signed_at\nc,a,b,d,2025-01-31\n",  # other order
        "client_id,company_name,industry,country,signed_at\nc,a,b,d,2025-01-31,extra\n",  # too many fields
    ],
)
def test_malformed_csv_raises(spark, folder, body):
    (folder / "clients.csv").write_text(body)
    with pytest.raises(Exception):
        csv_files.read_csv(spark, str(folder / "clients.csv"), BASE_TABLES["clients"]).collect()


def test_multiline_fields(spark, folder):
    (folder / "clients.csv").write_text(
        'client_id,company_name,industry,country,signed_at\nc_001,"two\nlines",a,b,2025-01-31\n'
    )
    df = csv_files.read_csv(spark, str(folder / "clients.csv"), BASE_TABLES["clients"], multiline=True)
    assert df.first().company_name == "two\nlines"


def one_task(spark, path, names):
    """The engine's own read of a file in one task."""
    return spark.read.options(header="true", quote='"', escape='"', multiLine="true", mode="FAILFAST", emptyValue="").csv(path).select(names)


@pytest.mark.parametrize("split", ["37", "400"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_are_read_in_many_tasks(spark, folder, split, end):
    """Whatever the splits: at any byte, inside quotes, between doubled quotes, in the middle of long fields."""
    rng = random.Random(4)
    rows = [[f"r{i}"] + ["".join(rng.choice('ab,"\n é') for _ in range(rng.randrange(1, 12))) for _ in range(3)] for i in range(60)]
    rows[7][2], rows[8][1], rows[9][3] = "\n\n\n", '"\n"', "x" * 300 + "\n" + "y" * 300
    quoted = lambda t: '"' + t.replace('"', '""') + '"'
    file = folder / "t.csv"
    file.write_bytes(("id,a,b,c" + end + end.join(",".join([r[0], *map(quoted, r[1:])]) for r in rows) + end).encode())
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "a", "b", "c")])
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in sizes}
    try:
        for key in sizes:
            spark.conf.set(key, split)
        splits = spark.read.text(str(file)).rdd.getNumPartitions()
        found = sorted(collected(csv_files.read_csv(spark, str(file), schema, missing=[], multiline=True)))
    finally:
        for key in sizes:
            spark.conf.set(key, before[key])
    assert splits > 4
    assert found == sorted(tuple(r) for r in rows)
    assert found == sorted(collected(one_task(spark, str(file), ["id", "a", "b", "c"])))


def test_multiline_headers_and_field_counts_are_checked(spark, folder):
    names = ("client_id", "company_name", "industry", "country", "signed_at")
    for name, body in {
        "header": "client_id,industry,company_name,country,signed_at\nc,a,b,d,2025-01-31\n",
        "more": ",".join(names) + "\nc,a,b,d,2025-01-31,extra\n",
        "fewer": ",".join(names) + '\nc,"a\nb"\n',
    }.items():
        (folder / f"{name}.csv").write_text(body)
        with pytest.raises(Exception):
            csv_files.read_csv(spark, str(folder / f"{name}.csv"), BASE_TABLES["clients"], multiline=True).collect()
    parts = folder / "parts.csv"
    parts.mkdir()
    for k in range(3):  # each part file has its header
        (parts / f"part-{k}.csv").write_text(",".join(names) + f'\nc_{k},"two\nlines",a,,\n\n')
    out = csv_files.read_csv(spark, str(parts), BASE_TABLES["clients"], multiline=True)
    assert sorted(collected(out)) == [(f"c_{k}", "two\nlines", "a", None, None) for k in range(3)]


def test_types_of_unlisted_tables(spark, folder):
    """The narrowest type of all values, as a data frame library on one machine gives them."""
    columns = {
        "whole": ["1", "-2", "+3", "007"], "gaps": ["1", "", "3", "NA"], "number": ["1", "2.5", "1e3", ".5"], "truth": ["True", "false", "TRUE", "False"],
        "truth_gap": ["True", "", "False", "True"], "mixed": ["1", "x", "2", "3"], "truth_number": ["True", "1", "0", "1"], "empty": ["", "", "", ""],
        "day": ["2025-01-31", "2025-02-01", "", "2025-02-02"], "large": ["9223372036854775808", "1", "2", "3"], "infinite": ["inf", "-inf", "1", "2"],
        "padded": [" 1", "2 ", "3", "4"],
    }
    lines = [",".join(columns)] + [",".join(c[i] for c in columns.values()) for i in range(4)]
    (folder / "extra.csv").write_text("\n".join(lines) + "\n")
    df = csv_files.read_csv(spark, str(folder / "extra.csv"))
    kinds = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string", "uint64": "double"}
    by_pandas = {name: kinds[str(kind)] for name, kind in pandas.read_csv(folder / "extra.csv").dtypes.items()}
    assert dict(df.dtypes) == by_pandas
    assert [r.whole for r in df.collect()] == [1, -2, 3, 7]
    assert [r.padded for r in df.collect()] == [1, 2, 3, 4]
    assert [r.infinite for r in df.collect()] == [float("inf"), float("-inf"), 1.0, 2.0]
    (folder / "none.csv").write_text("a,b\n")
    assert csv_files.read_csv(spark, str(folder / "none.csv")).collect() == []
    (folder / "lines.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    assert collected(csv_files.read_csv(spark, str(folder / "lines.csv"), multiline=True)) == [(1, "x\ny"), (2, "z")]


def test_discovery(spark, folder):
    with pytest.raises(FileNotFoundError):
        csv_files.discover(spark, str(folder))
    for name in ["b.csv", "a.csv", "c.txt"]:
        (folder / name).write_text("x\n1\n")
    assert [t for t, _ in csv_files.discover(spark, str(folder))] == ["a", "b"]


def test_write_load_and_load_again(spark, clean, folder):
    for name, frame in clean.items():
        csv_files.write_csv(frame, str(folder), name)
    namespace = "load_twice"
    reports = [collected(tables.load_folder(spark, str(folder), namespace)) for _ in range(2)]
    assert reports[0] == reports[1]
    assert reports[0] == [
        (f"{namespace}.{n}", {"applications": 9, "candidates": 5, "clients": 3, "marketing_daily": 4,
                              "placements": 4, "sales_deals": 4, "vacancies": 6}[n]) for n in sorted(clean)
    ]
    for name, frame in tables.read_namespace(spark, namespace).items():
        assert frame.columns[-1] == "_loaded_at"
        assert frame.select("_loaded_at").distinct().count() == 1
        assert frame.schema["_loaded_at"].dataType.simpleString() == "timestamp"
        assert sorted(map(repr, collected(frame.drop("_loaded_at")))) == sorted(map(repr, collected(clean[name])))


def test_missing_table_is_an_error(spark):
    tables.create_namespace(spark, "nothing_here")
    tables.create_namespace(spark, "nothing_here")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        tables.read_namespace(spark, "nothing_here")


def test_replace_changes_rows_and_schema_and_counts(spark):
    tables.create_namespace(spark, "replaced")
    assert tables.replace_table(spark.range(10), "replaced.t") == 10
    assert tables.replace_table(spark.range(3).select(F.lit("x").alias("s")), "replaced.t") == 3
    assert collected(spark.table("replaced.t")) == [("x",)] * 3
    assert tables.replace_table(spark.range(0), "replaced.t") == 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")).rstrip("/")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_partitioned_layout_skips_files(spark, clean):
    tables.create_namespace(spark, "by_month")
    marketing = clean["marketing_daily"].withColumn("month", F.trunc("date", "MONTH"))
    assert tables.replace_table(marketing, "by_month.marketing", ["month"]) == 4
    tables.append_table(marketing, "by_month.marketing", ["month"])
    january = spark.table("by_month.marketing").where("month = date'2025-01-01'")
    assert january.count() == 8
    assert tables.replace_table(marketing.where("month > date'2025-01-01'"), "by_month.marketing", ["month"]) < 4
    assert spark.table("by_month.marketing").where("month = date'2025-01-01'").count() == 0
    assert "PartitionFilters: [isnotnull(month" in january._jdf.queryExecution().executedPlan().toString()


def test_readers_keep_the_version_they_resolved(spark):
    tables.create_namespace(spark, "versions")
    tables.replace_table(spark.range(10), "versions.t")
    before = spark.table("versions.t")
    tables.replace_table(spark.range(3).select("id", F.lit("x").alias("s")), "versions.t")
    assert before.count() == 10
    tables.replace_table(spark.table("versions.t").where("id > 0"), "versions.t")  # reads what it replaces
    assert collected(spark.table("versions.t").orderBy("id")) == [(1, "x"), (2, "x")]
    stored = [t.name for t in spark.catalog.listTables("versions") if t.name.startswith("t__v_")]
    assert len(stored) == 2  # the current one and the one before


def test_a_failed_replacement_leaves_nothing(spark):
    tables.create_namespace(spark, "failing")
    tables.replace_table(spark.range(4).withColumn("part", F.col("id") % 2), "failing.t", ["part"])
    broken = spark.range(4).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("on purpose"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="on purpose"):
        tables.replace_table(broken, "failing.t")
    assert spark.table("failing.t").count() == 4
    assert len(spark.catalog.listTables("failing")) == 2


def test_plain_tables_are_taken_over(spark):
    tables.create_namespace(spark, "plain")
    spark.range(5).write.saveAsTable("plain.t")
    tables.append_table(spark.range(5, 7), "plain.t")
    assert spark.table("plain.t").count() == 7
    assert tables.replace_table(spark.table("plain.t").where("id < 3"), "plain.t") == 3
    assert spark.table("plain.t").count() == 3


def test_repeated_appends_leave_one_copy(spark):
    tables.create_namespace(spark, "once")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "run_id string, n int")
    for _ in range(2):
        tables.append_table(rows, "once.log", once=["run_id"])
    tables.append_table(spark.createDataFrame([("b", 9), ("c", 3), ("c", 4)], rows.schema), "once.log", once=["run_id"])
    assert sorted(collected(spark.table("once.log"))) == [("a", 1), ("b", 2), ("c", 3), ("c", 4)]
    tables.append_table(rows, "once.log")
    assert spark.table("once.log").count() == 6
