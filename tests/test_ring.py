"""Which messages survive in bounded buffers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators import ring
from chargestream.plans.flush import flush

from .conftest import column

CLIENT = ["client_id"]


def seqs(df):
    return sorted(row.seq for row in df.select("seq").collect())


@pytest.mark.parametrize(("capacity", "kept"), [(1, [11]), (11, [*range(1, 12)]), (12, [*range(12)]), (13, [*range(12)])])
def test_capacity_bounds(ocpi, capacity, kept):
    assert seqs(ocpi(*[{}] * 12).transform(ring.keep_newest, capacity, CLIENT)) == kept


def test_each_client_has_its_own_buffer(ocpi):
    rng = random.Random(5)
    clients = [rng.choice(["hot"] * 4 + ["a", None]) for _ in range(60)]
    got = ocpi(*[{"client_id": client} for client in clients]).transform(ring.keep_newest, 7, CLIENT)
    want = [
        at
        for client in {"hot", "a", None}
        for at in [at for at, name in enumerate(clients) if name == client][-7:]
    ]
    assert seqs(got) == sorted(want)


def test_rejected_messages_take_no_room(ocpi):
    bad = F.when(F.col("seq") >= 8, F.lit(C.INVALID_IDENTITY))
    marked = ocpi(*[{}] * 12).withColumn("drop_reason", bad).transform(ring.mark_ring_overflow, 5, CLIENT)
    reasons = column(marked, "drop_reason")
    assert reasons == [C.RING_OVERFLOW] * 3 + [None] * 5 + [C.INVALID_IDENTITY] * 4


def test_capacity_per_row(ocpi):
    df = ocpi(*[{"client_id": "a"}] * 4, *[{"client_id": "b"}] * 4)
    df = df.withColumn("capacity", F.when(F.col("client_id") == "a", 1).otherwise(3))
    assert seqs(df.transform(ring.keep_newest, F.col("capacity"), CLIENT)) == [3, 5, 6, 7]


def test_one_buffer_per_cycle(ocpi):
    df = ocpi(*[{}] * 12).withColumn("cycle", F.floor(F.col("seq") / 4))
    assert seqs(df.transform(ring.keep_newest, 2, ["client_id", "cycle"])) == [2, 3, 6, 7, 10, 11]


def test_newest_of_a_single_client(ocpi):
    df = ocpi(*[{}] * 12)
    assert seqs(ring.newest(df, 5)) == [7, 8, 9, 10, 11]
    assert seqs(ring.newest(df, 12)) == seqs(ring.newest(df, 100)) == [*range(12)]


def test_small_limits_are_broadcast_and_bodies_stay_where_they_are(spark, ocpi):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = ocpi(*[{}] * 12).transform(ring.mark_ring_overflow, 5, CLIENT)
        plan = marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_hot_client_is_split_when_the_limits_are_large(skewed, assert_skew_is_split):
    df = skewed.withColumnRenamed("key", "client_id")
    assert_skew_is_split(df.transform(ring.mark_ring_overflow, 5, CLIENT), skewed.count())


def test_large_limits_are_joined_without_broadcast(spark, ocpi):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ocpi(*[{}] * 12, *[{"client_id": None}] * 8).transform(ring.keep_newest, 5, CLIENT)
        assert seqs(got) == [7, 8, 9, 10, 11, 15, 16, 17, 18, 19]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_buffer_has_to_be_named(ocpi):
    with pytest.raises(ValueError, match="keys"):
        flush(ocpi({}).withColumn("drop_reason", F.lit(None).cast("string")), C.OCPI, 5)
