"""Run queries beside their oracles: `python -m tests.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    """Column names in order, and the rows as sorted text in that order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(connection, sql):
    result = connection.execute(sql)
    return canonical([column[0] for column in result.description], result.fetchall())


def main(sf_dir="/root/testdata/sf0.01", *names):
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
            took = time.time() - start
            want = oracle_rows(duck(sf_dir), oracles[name])
        except Exception as error:
            bad += 1
            print(f"{name:28} ERROR {str(error)[:700]}")
            continue
        if got == want:
            print(f"{name:28} ok {len(got[1]):7} rows {took:6.2f} s")
        else:
            bad += 1
            print(f"{name:28} DIFFERS columns {got[0] == want[0]} rows {len(got[1])} / {len(want[1])}")
            print("   ", got[0], want[0])
            print("    only Spark:", sorted(set(got[1]) - set(want[1]))[:2])
            print("    only DuckDB:", sorted(set(want[1]) - set(got[1]))[:2])
    print("bad:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
