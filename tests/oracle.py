"""Runs queries on Spark and their SQL on DuckDB and compares the rows.

As a script: python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tollgate.queries import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([(columns[i], row[i]) for i in order]) for row in rows)


def spark_rows(spark, name: str, sf_dir: str) -> list[str]:
    df = QUERIES[name](spark, sf_dir)
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, name: str) -> list[str]:
    found = con.execute(ORACLES[name])
    return rows_of([d[0] for d in found.description], found.fetchall())


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), []
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            got = spark_rows(spark, name, sf_dir)
            spent = time.time() - start
            want = sql_rows(con, name) if name in ORACLES else None
        except Exception as err:
            print(f"ERROR {name}: {str(err)[:1500]}", flush=True)
            failed.append(name)
            continue
        good = want is None or got == want
        note = "rows only" if want is None else ""
        print(f"{'ok' if good else 'DIFF':5}{name} {len(got)} rows {spent:.1f}s {note}", flush=True)
        if not good:
            failed.append(name)
            print("   spark", len(got), sorted(set(got) - set(want))[:3])
            print("   sql  ", len(want), sorted(set(want) - set(got))[:3])
    spark.stop()
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
