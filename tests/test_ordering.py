"""Totals and positions against brute force, on skewed, sparse and extreme order columns."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chargestream.operators import ordering as O

ORDERS = {
    "dense": lambda rng, n: range(n),
    "negative": lambda rng, n: range(-n // 2, n - n // 2),
    "sparse": lambda rng, n: rng.sample(range(-(2**62), 2**62, 2), n),
    "ends": lambda rng, n: [-(2**63), *range(n - 2), 2**63 - 1],
}


def brute(rows):
    totals, out = defaultdict(int), {}
    for key, order, value in sorted(rows, key=lambda row: row[1]):
        totals[key] += value
        out[key, order] = totals[key]
    return out


@pytest.mark.parametrize("kind", ORDERS)
@pytest.mark.parametrize("bits", [2, 14])
def test_running_total(spark, kind, bits):
    rng = random.Random(7)
    orders = list(ORDERS[kind](rng, 400))
    # One key holds most rows; one key is null.
    rows = [(rng.choice(["hot"] * 6 + ["a", None]), order, rng.randint(-3, 3)) for order in orders]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k STRING, seq BIGINT, v BIGINT").repartition(5)
    out = O.running_total(df, ["k"], F.col("v"), "total", bucket_bits=bits)
    assert out.columns == ["k", "seq", "v", "total"]
    got = {(row.k, row.seq): row.total for row in out.collect()}
    assert got == brute(rows)


def test_two_keys_and_wide_columns(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice([None, "x", "y"]), seq, {"h": str(seq)}) for seq in range(300)]
    df = spark.createDataFrame(rows, "k STRING, l STRING, seq BIGINT, m MAP<STRING,STRING>")
    got = O.with_position(df, ["k", "l"], bucket_bits=3).collect()
    assert len(got) == 300 and all(row.m == {"h": str(row.seq)} for row in got)
    want = brute([((k, l), seq, 1) for k, l, seq, _ in rows])
    assert {((row.k, row.l), row.seq): row.position + 1 for row in got} == want


def test_newest_first(spark):
    df = spark.range(10).select(F.lit("k").alias("k"), F.col("id").alias("seq"))
    aged = O.with_position(df, ["k"], "age", order=F.bitwise_not("seq"))
    assert {row.seq: row.age for row in aged.collect()} == {seq: 9 - seq for seq in range(10)}


def test_no_rows(spark):
    df = spark.createDataFrame([], "k STRING, seq BIGINT")
    assert O.with_position(df, ["k"]).collect() == []


def test_fifo_sorts_inside_partitions(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), (100 - F.col("id")).alias("seq"))
    parts = O.fifo(df.repartition(4), "k").withColumn("p", F.spark_partition_id()).collect()
    for part in range(4):
        found = [(row.k, row.seq) for row in parts if row.p == part]
        assert found == sorted(found)


def test_the_hot_key_is_spread_over_tasks(spark):
    """With one key, the wide rows still meet in many partitions."""
    df = spark.range(4096).select(F.lit("hot").alias("k"), F.col("id").alias("seq"))
    off = "spark.sql.adaptive.enabled"
    spark.conf.set(off, "false")
    try:
        out = O.with_position(df, ["k"], bucket_bits=6)
        sizes = out.groupBy(F.spark_partition_id()).agg(F.count("position").alias("n")).collect()
    finally:
        spark.conf.set(off, "true")
    assert len(sizes) == 4 and max(row.n for row in sizes) < 2048
