"""Connections of charge points."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators import admission as A
from chargestream.operators import sessions as S
from chargestream.session import stage
from chargestream.streaming import sessions as stream_sessions

from .conftest import by_seq, column


def test_ids_change_with_every_connect(ocpp):
    kinds = [C.MESSAGE, C.CONNECT, C.MESSAGE, C.DISCONNECT, C.MESSAGE, C.CONNECT, C.DISCONNECT]
    rows = by_seq(ocpp(*[{"event_type": kind} for kind in kinds]).transform(S.assign_connections))
    ids = [row.connection_id for row in rows]
    assert ids[0] is None
    assert len(set(ids[1:5])) == 1 and len(set(ids[5:])) == 1 and ids[1] != ids[5]


def test_a_rejected_connect_still_opens_a_connection(ocpp):
    events = ocpp({"event_type": 1, "tenant_id": "half"}, {"payload": b"f", "direction": "TO_CP"})
    rows = by_seq(events.transform(S.assign_connections).transform(A.admit_ocpp))
    assert rows[0].drop_reason == C.INVALID_IDENTITY and rows[1].drop_reason is None
    assert rows[0].connection_id == rows[1].connection_id is not None


def test_ids_of_different_chargers_never_meet(spark):
    pairs = [("a:b", "c"), ("a", "b:c"), ("a", "b"), ("", "ab"), ("ab", "")]
    df = spark.createDataFrame([(c, p, n) for c, p in pairs for n in (1, 2, 12)], "c STRING, p STRING, n BIGINT")
    ids = df.select(S.connection_id(F.col("c"), F.col("p"), F.col("n")).alias("id")).collect()
    assert len({row.id for row in ids}) == len(pairs) * 3


def test_ordinals_against_brute_force(ocpp):
    rng = random.Random(11)
    events = [
        {"client_id": rng.choice("xy"), "charger_id": rng.choice(["hot"] * 5 + ["a", " "]), "event_type": rng.randint(0, 2)}
        for _ in range(500)
    ]
    want, seen = [], defaultdict(int)
    for event in events:
        key = event["client_id"], event["charger_id"]
        seen[key] += event["event_type"] == C.CONNECT
        want.append(seen[key])
    df = ocpp(*events).repartition(6)
    assert column(df.transform(S.with_connection_ordinal), "ordinal") == want


def test_many_connects_of_one_bucket(ocpp, monkeypatch):
    monkeypatch.setattr(S, "_STRIDE", 4)
    rng = random.Random(3)
    kinds = [rng.choice([C.CONNECT, C.CONNECT, C.MESSAGE]) for _ in range(300)]
    places = [0, (1 << 20) - 1, 1 << 20, *rng.sample(range(1 << 22), 297)]
    events = ocpp(*[{"seq": seq - 5, "event_type": kind} for seq, kind in zip(sorted(places), kinds, strict=True)])
    want = [sum(kind == C.CONNECT for kind in kinds[: at + 1]) for at in range(300)]
    assert column(events.repartition(3).transform(S.with_connection_ordinal), "ordinal") == want


def frames(spark, *rows):
    return spark.createDataFrame(rows, "seq BIGINT, connection_id STRING, direction STRING, payload BINARY")


def connections(spark, *rows):
    return spark.createDataFrame(rows, "connection_id STRING, charger_id STRING, tenant_id STRING, tenant_name STRING")


def test_session_life_cycle(spark):
    known = connections(spark, ("line-7", "post-3", "north", "North Grid"))
    sent = frames(spark, *[(at, "line-7", "TO_CP" if at % 2 else "FROM_CP", bytearray(b"%d" % at)) for at in range(9, 2, -1)])
    rows = S.session_events(sent, known).orderBy("phase", "seq").collect()
    assert [row.event_type for row in rows] == [C.CONNECT, *[C.MESSAGE] * 7, C.DISCONNECT]
    assert {(row.connection_id, row.charger_id, row.tenant_id, row.tenant_name) for row in rows} == {
        ("line-7", "post-3", "north", "North Grid")
    }
    assert all((row.seq, row.direction, row.payload) == (None, None, None) for row in (rows[0], rows[-1]))
    assert [(row.seq, row.payload) for row in rows[1:-1]] == [(at, b"%d" % at) for at in range(3, 10)]


def test_frames_of_an_unknown_connection_are_rejected_and_none_is_lost(spark):
    known = connections(spark, ("k", "post", None, None))
    sent = frames(spark, *[(at, name, "TO_CP", bytearray(b"f")) for at, name in enumerate(["k", "gone", None, "k", "gone"])])
    rows = S.session_events(sent, known).where("phase = 1").transform(A.admit_ocpp)
    assert column(rows, "drop_reason") == [None, C.UNKNOWN_CONNECTION, C.UNKNOWN_CONNECTION, None, C.UNKNOWN_CONNECTION]
    assert A.admitted(rows).count() + rows.where("drop_reason IS NOT NULL").count() == sent.count()


def test_a_connection_without_frames_still_connects_and_disconnects(spark):
    rows = S.session_events(frames(spark), connections(spark, ("c1", "CP", None, None))).collect()
    assert sorted(row.event_type for row in rows) == [C.DISCONNECT, C.CONNECT]


def test_events_of_an_invalid_identity_are_all_rejected(spark):
    known = connections(spark, ("c1", "  ", None, None), ("c2", "CP", "t", None))
    sent = frames(spark, (1, "c1", "TO_CP", bytearray(b"f")), (2, "c2", "TO_CP", bytearray(b"f")))
    rows = S.session_events(sent, known).transform(A.admit_ocpp).collect()
    assert [row.drop_reason for row in rows] == [C.INVALID_IDENTITY] * 6


def test_a_hot_connection_is_split_when_its_table_is_large(skewed, assert_skew_is_split):
    """Without a broadcast, AQE splits the partition that one connection fills."""
    sent = skewed.withColumnRenamed("key", "connection_id")
    known = stage(sent.select("connection_id").distinct().withColumn("charger_id", F.lit("CP")), "connections")
    assert_skew_is_split(S.with_identity(sent, known), skewed.count())


def timed(spark, path, schema, *batches):
    """A stream of micro-batches, one per list of rows."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("spread", [1, 4])
def test_frames_of_a_stream_find_their_connect_or_are_unknown(spark, tmp_path, spread):
    at = lambda minutes: datetime(2026, 1, 1, tzinfo=UTC) + timedelta(minutes=minutes)
    hot = [("hot", n, at(5 + n / 100), b"x") for n in range(40)]
    frames_in = [
        [("early", 100, at(0), b"a"), *hot, (None, 101, at(3), b"b")],
        [("lost", 102, at(6), b"c"), ("old", 103, at(130), b"d")],
        [("end", 104, at(5000), b"")],
        [("end", 105, at(9000), b"")],
    ]
    connects_in = [
        [("hot", at(5), "CP-hot"), ("old", at(1), "CP-old")],
        [("early", at(2), "CP-early")],
        [("end", at(5000), "CP-end")],
        [("end", at(9000), "CP-end")],
    ]
    frames_ = timed(spark, f"{tmp_path}/f", "connection_id string, seq long, captured_ts timestamp, payload binary", *frames_in)
    connects = timed(spark, f"{tmp_path}/c", "connection_id string, captured_ts timestamp, charger_id string", *connects_in)
    joined = stream_sessions.with_identity(frames_, connects, "180 minutes", "60 minutes", spread)
    writer = joined.writeStream.option("checkpointLocation", f"{tmp_path}/p").trigger(availableNow=True)
    writer.format("parquet").start(f"{tmp_path}/out").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").where("connection_id is null or connection_id <> 'end'").collect()
    got = sorted((row.seq, row.charger_id, row.drop_reason) for row in rows)
    unknown = C.UNKNOWN_CONNECTION
    assert got == [(n, "CP-hot", None) for n in range(40)] + [
        (100, "CP-early", None), (101, None, unknown), (102, None, unknown), (103, None, unknown),
    ]
