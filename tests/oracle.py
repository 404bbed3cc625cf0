"""Run registered queries next to their oracle SQL: `python tests/oracle.py [names...]`."""

from __future__ import annotations

import os
import sys
import time
import traceback
from datetime import datetime
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'"
        ).fetchall()
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.6f}"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, connection, name, fn, sql, sf_dir):
    """(spark rows, seconds, problem or None)."""
    start = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    if sql is None:
        return len(got), seconds, None
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(got), seconds, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return (
            len(got),
            seconds,
            f"{len(a)} vs {len(b)} rows; cols {sorted(names)}\n  spark only {only_a}\n  duck only  {only_b}",
        )
    return len(got), seconds, None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, connection = session(), duck(sf_dir)
    wanted = sys.argv[1:]
    bad = 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        try:
            n, seconds, problem = compare(
                spark, connection, name, fn, oracle_sql().get(name), sf_dir
            )
            kind = "" if name in oracle_sql() else " (rows only)"
        except Exception as error:  # report and go on
            n, seconds, kind = 0, 0.0, ""
            problem = traceback.format_exc() if os.environ.get("TRACE") else str(error)[:700]
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} rows={n} {seconds:.2f}s{kind}", flush=True)
        if problem:
            print("  " + problem, flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
