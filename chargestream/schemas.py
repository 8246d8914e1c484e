"""Schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_HEADERS = MapType(StringType(), StringType())


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


OCPI_CAPTURE = _struct(
    seq=LongType(),
    client_id=StringType(),
    captured_ts=TimestampType(),
    direction=StringType(),
    platform_id=StringType(),
    platform_name=StringType(),
    tenant_id=StringType(),
    tenant_name=StringType(),
    method=StringType(),
    url=StringType(),
    status_code=IntegerType(),
    request_headers=_HEADERS,
    response_headers=_HEADERS,
    request_body=BinaryType(),
    response_body=BinaryType(),
)

OCPP_CAPTURE = _struct(
    seq=LongType(),
    client_id=StringType(),
    captured_ts=TimestampType(),
    event_type=IntegerType(),
    charger_id=StringType(),
    tenant_id=StringType(),
    tenant_name=StringType(),
    connection_id=StringType(),
    direction=StringType(),
    payload=BinaryType(),
)

# The two records list their fields in wire order.
OCPI_RECORD = _struct(
    captured_at=StringType(),
    platform_id=StringType(),
    platform_name=StringType(),
    tenant_id=StringType(),
    tenant_name=StringType(),
    direction=StringType(),
    http_method=StringType(),
    url=StringType(),
    response_status_code=IntegerType(),
    request_headers=_HEADERS,
    request_body=StringType(),
    response_headers=_HEADERS,
    response_body=StringType(),
)

OCPP_RECORD = _struct(
    charger_id=StringType(),
    connection_id=StringType(),
    tenant_id=StringType(),
    tenant_name=StringType(),
    captured_at=StringType(),
    event_type=IntegerType(),
    direction=StringType(),
    raw_frame=StringType(),
)

REJECTED = _struct(
    client_id=StringType(), seq=LongType(), protocol=StringType(), drop_reason=StringType()
)

DELIVERY_ATTEMPT = _struct(
    batch_id=LongType(),
    protocol=StringType(),
    n_messages=LongType(),
    attempt=IntegerType(),
    status=IntegerType(),
)

CLIENT_CONFIG = _struct(
    client_id=StringType(),
    endpoint=StringType(),
    has_api_key=BooleanType(),
    buffer_capacity=IntegerType(),
    max_capture_bytes=IntegerType(),
    flush_interval=DoubleType(),
    drain_timeout=DoubleType(),
    compression=StringType(),
    debug=BooleanType(),
    allowed_headers=ArrayType(StringType()),
)


def envelope(record: StructType) -> StructType:
    """Schema of a batch body that carries records of the given kind."""
    return _struct(messages=ArrayType(record))
