"""Run registered queries against their oracle SQL: columns, types and values.

``python -m tests.oracle_compare FOLDER [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql):
    """None when both sides agree, else what differs."""
    relation = con.sql(sql)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema}
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != sql_types:
        return f"types: {sorted(set(spark_types.items()) ^ set(sql_types.items()))}"
    ours = rows_of(spark_df.columns, spark_df.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} and {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"values: {a} and {b}"
    return None


def main():
    import __spark_entry__ as entry
    from hirelattice.session import build_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(folder), entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            found = difference(query(spark, folder), con, oracle[name]) if name in oracle else "no oracle"
        except Exception as broken:
            found = f"{type(broken).__name__}: {str(broken)[:600]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    print("unused oracle:", sorted(set(oracle) - set(entry.queries())))


if __name__ == "__main__":
    main()
