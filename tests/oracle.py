"""Compare registered queries with their check SQL in DuckDB.

``python tests/oracle.py [--sf DIR] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def norm(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return "DECIMAL:" + str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(norm(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(row[i]) for i in order) for row in rows)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date",
}


def compare(spark, con, query, check, sf_dir):
    started = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    types = dict(df.dtypes)
    if check is None:
        return took, len(got), None, "rows only"
    relation = con.sql(check)
    expected = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return took, len(got), False, f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    odd = [
        f"{c}:{types[c]}/{t}"
        for c, t in zip(relation.columns, map(str, relation.types))
        if KINDS.get(t, t) != types[c]
    ]
    a, b = rows_of(df.columns, got), rows_of(relation.columns, expected)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return took, len(got), False, (
            f"{len(a)}/{len(b)} rows; {sorted(df.columns)}\n   spark {only_a}\n   duck  {only_b}"
        )
    return took, len(got), True, ("types " + " ".join(odd)) if odd else ""


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    spark, con = session(), connect(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    wanted = [n for n in queries if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    bad = 0
    for name in wanted:
        try:
            took, n, ok, note = compare(spark, con, queries[name], checks.get(name), sf_dir)
        except Exception as error:  # keep going: one line per query
            took, n, ok, note = 0.0, -1, False, f"{type(error).__name__}: {str(error)[:700]}"
        flag = {True: "ok  ", False: "FAIL", None: "rows"}[ok]
        if ok is False or note or n == 0 or took > 4:
            print(f"{flag} {name:40s} {n:7d} rows {took:6.2f}s {note}", flush=True)
        bad += ok is False
    print(f"{len(wanted)} queries, {bad} failed")


if __name__ == "__main__":
    main()
