"""Who is admitted, and why the others are not."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream.operators import admission as A

from .conftest import by_seq, column


def test_roaming_identity(ocpi):
    bad = [
        {"platform_id": ""},
        {"platform_name": "   "},
        {"platform_id": None},
        {"platform_id": " \x1c"},
        {"tenant_id": "t"},
        {"tenant_name": "T"},
        {"tenant_id": "t", "tenant_name": " "},
    ]
    good = [{}, {"tenant_id": "t", "tenant_name": "T"}, {"tenant_id": "", "tenant_name": "  "}]
    reasons = column(ocpi(*bad, *good).transform(A.admit_ocpi), "drop_reason")
    assert reasons == [C.INVALID_IDENTITY] * len(bad) + [None] * len(good)


def test_body_cap_is_inclusive_and_in_bytes(ocpi):
    df = ocpi(
        {"request_body": b"x" * 17},
        {"response_body": b"y" * 17},
        {"request_body": b"z" * 16, "response_body": b"z" * 16},
        {"request_body": "é".encode() * 8 + b"x"},
        {"request_body": b"x" * 17, "response_body": b"y" * 17},
        {"request_body": b"x" * 17, "platform_id": " "},
    )
    assert column(df.transform(A.admit_ocpi, 16), "drop_reason") == [
        C.REQUEST_BODY_OVERSIZE,
        C.RESPONSE_BODY_OVERSIZE,
        None,
        C.REQUEST_BODY_OVERSIZE,
        C.REQUEST_BODY_OVERSIZE,
        C.INVALID_IDENTITY,
    ]


def test_default_cap(ocpi):
    df = ocpi({"request_body": b"x" * 65_536}, {"request_body": b"x" * 65_537})
    assert column(df.transform(A.admit_ocpi), "drop_reason") == [None, C.REQUEST_BODY_OVERSIZE]


def test_cap_may_be_a_column(ocpi):
    df = ocpi({"request_body": b"xx"}, {"request_body": b"xx"}).withColumn("cap", F.col("seq") + 1)
    assert column(df.transform(A.admit_ocpi, F.col("cap")), "drop_reason") == [C.REQUEST_BODY_OVERSIZE, None]


def test_frames_need_data_and_direction(ocpp):
    df = ocpp(
        {},
        {"payload": b"frame"},
        {"direction": "TO_CP"},
        {"payload": b"", "direction": "TO_CP"},
        {"payload": b"frame", "direction": "TO_CP"},
        {"charger_id": " "},
    )
    assert column(df.transform(A.admit_ocpp), "drop_reason") == [
        C.INCOMPLETE_FRAME,
        C.INCOMPLETE_FRAME,
        C.INCOMPLETE_FRAME,
        None,
        None,
        C.INCOMPLETE_FRAME,
    ]


def test_oversize_frame_is_dropped_and_the_connect_kept(ocpp):
    frame = {"direction": "TO_CP"}
    df = ocpp({"event_type": 1}, {**frame, "payload": b"x" * 9}, {**frame, "payload": b"y" * 8})
    assert column(df.transform(A.admit_ocpp, 8), "drop_reason") == [None, C.FRAME_OVERSIZE, None]


@pytest.mark.parametrize("event_type", [C.CONNECT, C.MESSAGE, C.DISCONNECT])
def test_charger_identity_on_every_kind_of_event(ocpp, event_type):
    event = {"event_type": event_type, "payload": b"f", "direction": "TO_CP"}
    df = ocpp(
        {**event, "charger_id": "  "},
        {**event, "tenant_id": "t1"},
        {**event, "connection_id": ""},
        {**event, "connection_id": None},
    )
    reasons = column(df.transform(A.admit_ocpp), "drop_reason")
    assert reasons == [C.INVALID_IDENTITY, C.INVALID_IDENTITY, None, None]


def test_split_loses_nothing(ocpi):
    df = ocpi({}, {"platform_id": ""}, {"request_body": b"x" * 9}).transform(A.admit_ocpi, 8)
    kept, lost = A.split(df, C.OCPI)
    assert [row.seq for row in by_seq(kept)] == [0]
    assert [tuple(row) for row in by_seq(lost)] == [
        ("gw", 1, "ocpi", C.INVALID_IDENTITY),
        ("gw", 2, "ocpi", C.REQUEST_BODY_OVERSIZE),
    ]
    assert "drop_reason" not in kept.columns


def test_an_earlier_reason_stays(ocpi):
    df = ocpi({"platform_id": ""}).withColumn("drop_reason", F.lit(C.INERT_CLIENT))
    assert column(df.transform(A.admit_ocpi), "drop_reason") == [C.INERT_CLIENT]


def test_withhold_empties_rejected_rows_only(ocpi):
    df = ocpi({"request_body": b"a"}, {"request_body": b"b", "platform_id": ""}).transform(A.admit_ocpi)
    assert column(df.transform(A.withhold, "request_body"), "request_body") == [b"a", None]


def test_directions(ocpi):
    inbound = ocpi({"url": "/in"}).drop("direction")
    outbound = ocpi({"url": "/out"}).drop("direction")
    both = A.stamp_direction(inbound, outbound).select("url", "direction").collect()
    assert {row.url: row.direction for row in both} == {"/in": "IN", "/out": "OUT"}


def test_receive_time_is_stamped_only_where_missing(spark, ocpp):
    given = ocpp({}).withColumn("captured_ts", F.timestamp_seconds(F.lit(0)))
    assert column(given.transform(A.stamp_received), "captured_ts")[0].timestamp() == 0
    assert column(ocpp({}).transform(A.stamp_received), "captured_ts")[0] is not None
    assert column(ocpp({}).drop("captured_ts").transform(A.stamp_received), "captured_ts")[0] is not None


def test_event_codes_and_projection(ocpp):
    raw = {"payload": b"f", "direction": "TO_CP"}
    names = ["CONNECT", "MESSAGE", "DISCONNECT", "OTHER"]
    df = ocpp(*[raw] * 4).drop("event_type")
    mapping = F.element_at(F.array(*[F.lit(name) for name in names]), (F.col("seq") + 1).cast("int"))
    rows = by_seq(df.withColumn("event_name", mapping).transform(A.ocpp_events))
    assert [row.event_type for row in rows] == [1, 2, 0, None]
    assert [row.payload for row in rows] == [None, b"f", None, None]
    assert [row.direction for row in rows] == [None, "TO_CP", None, None]
    reasons = column(df.withColumn("event_name", mapping).transform(A.ocpp_events).transform(A.admit_ocpp), "drop_reason")
    assert reasons == [None, None, None, C.INCOMPLETE_FRAME]


def test_text_frames_become_bytes(ocpp):
    df = ocpp({"direction": "TO_CP"}).withColumn("payload", F.lit('[2,"é"]'))
    assert by_seq(df.transform(A.ocpp_events))[0].payload == '[2,"é"]'.encode()
