"""Configuration of clients."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chargestream import constants as C
from chargestream import schemas
from chargestream.operators import clients as K
from chargestream.operators.ring import mark_ring_overflow
from chargestream.plans.flush import prepare_ocpi_per_client, prepare_ocpp_per_client
from chargestream.session import stage

from .conftest import by_seq, column


def test_defaults(config):
    row = K.resolve_config(config({"endpoint": "https://ingest.example.com/"})).collect()[0]
    assert row.endpoint == "https://ingest.example.com" and row.active
    assert (row.buffer_capacity, row.max_capture_bytes) == (10_000, 65_536)
    assert (row.flush_interval, row.drain_timeout, row.compression) == (5.0, 10.0, "zstd")
    assert (row.debug, row.allowed_headers) == (False, [])


# Just under each minimum, and a codec that is not offered.
BAD = {
    "buffer_capacity": C.MIN_BUFFER_CAPACITY - 1,
    "max_capture_bytes": C.MIN_MAX_CAPTURE_BYTES - 1,
    "flush_interval": C.MIN_FLUSH_INTERVAL / 2,
    "drain_timeout": C.MIN_DRAIN_TIMEOUT - 0.25,
    "compression": "".join(C.COMPRESSIONS),
}


def test_bad_values_fall_back_and_are_named(config):
    df = config({**BAD, "debug": True})
    row = K.resolve_config(df).collect()[0]
    assert (row.buffer_capacity, row.max_capture_bytes) == (10_000, 65_536)
    assert (row.flush_interval, row.drain_timeout, row.compression) == (5.0, 10.0, "zstd")
    assert K.config_warnings(df).collect()[0].warnings == list(BAD)


def test_nan_falls_back_and_is_named(config):
    df = config({"flush_interval": float("nan"), "debug": True})
    assert K.resolve_config(df).collect()[0].flush_interval == 5.0
    assert K.config_warnings(df).collect()[0].warnings == ["flush_interval"]


def test_no_warnings_without_debug(config):
    found = K.config_warnings(config(BAD, {**BAD, "debug": False}, {"debug": True})).collect()
    assert [row.warnings for row in found] == [None, None, []]


def test_smallest_values_are_accepted(config):
    given = {"buffer_capacity": 1, "max_capture_bytes": 1, "flush_interval": 0.001, "drain_timeout": 5.0}
    df = config({**given, "debug": True})
    row = K.resolve_config(df).collect()[0]
    assert {name: row[name] for name in given} == given
    assert K.config_warnings(df).collect()[0].warnings == []


def test_headers_are_normalised(config):
    df = config({"allowed_headers": ["Region\t", None, "", "REGION", " lane-2"], "debug": True})
    assert K.resolve_config(df).collect()[0].allowed_headers == ["region", "lane-2"]
    assert K.config_warnings(df).collect()[0].warnings == ["allowed_headers"]


@pytest.mark.parametrize(
    "bad",
    [{"endpoint": e} for e in (None, "\t", "https:", "//host/only", "ws://sink.example.org/v1", "sink.example.org")]
    + [{"has_api_key": False}, {"has_api_key": None}],
)
def test_inert_clients(config, ocpi, bad):
    df = config({"client_id": "gw", **bad}, {"client_id": "ok"})
    captures = ocpi({"client_id": "gw"}, {"client_id": "ok"}, {"client_id": "stranger"}, {"client_id": None})
    assert [row.client_id for row in K.active_clients(df).collect()] == ["ok"]
    assert column(K.exclude_inert(captures, df), "seq") == [1]
    lost = by_seq(K.only_inert(captures, df))
    assert [(row.seq, row.drop_reason) for row in lost] == [(at, C.INERT_CLIENT) for at in (0, 2, 3)]
    marked = by_seq(K.with_config(captures, df))
    assert [row.drop_reason for row in marked] == [C.INERT_CLIENT, None, C.INERT_CLIENT, C.INERT_CLIENT]


def test_each_client_gets_its_own_limits(config, ocpi):
    df = config(
        {"client_id": "a", "max_capture_bytes": 4, "allowed_headers": ["X-Trace"], "buffer_capacity": 1},
        {"client_id": "b"},
    )
    captures = [
        {"client_id": name, "request_body": body, "request_headers": {"X-Trace": "t", "accept": "*"}}
        for name in "ab"
        for body in (b"1234", b"12345", b"1")
    ]
    prepared = prepare_ocpi_per_client(ocpi(*captures), df)
    rows = by_seq(mark_ring_overflow(prepared, F.col("config.buffer_capacity"), ["client_id"]))
    assert [row.drop_reason for row in rows] == [
        C.RING_OVERFLOW,
        C.REQUEST_BODY_OVERSIZE,
        None,
        None,
        None,
        None,
    ]
    assert rows[2].request_headers == {"X-Trace": "t", "accept": "*"}
    assert rows[3].request_headers == {"accept": "*"}


def test_a_hot_client_is_split_when_the_configuration_is_large(spark, skewed, assert_skew_is_split):
    captures = skewed.withColumnRenamed("key", "client_id")
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schemas.CLIENT_CONFIG.fields[1:]]
    clients = captures.select("client_id").distinct().select("client_id", *columns)
    clients = clients.withColumns({"endpoint": F.lit("https://x.example.com"), "has_api_key": F.lit(True)})
    table = stage(clients, "config")
    for joined in (K.with_config(captures, table), K.exclude_inert(captures, table)):
        assert_skew_is_split(joined, skewed.count())


def test_frame_cap_per_client(config, ocpp):
    df = config({"client_id": "csms", "max_capture_bytes": 2})
    events = ocpp(*[{"payload": body, "direction": "TO_CP"} for body in (b"12", b"123")])
    assert column(prepare_ocpp_per_client(events, df), "drop_reason") == [None, C.FRAME_OVERSIZE]
