"""Flat wire records. `client_id`, `seq` and `protocol` stay beside them as keys, with the flush and the client's codec where known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..functions import body_base64, headers_or_null, null_if_empty, null_if_zero, wire_timestamp

OCPI_FIELDS = schemas.OCPI_RECORD.fieldNames()
OCPP_FIELDS = schemas.OCPP_RECORD.fieldNames()


def _keys(df: DataFrame, protocol: str) -> list[Column]:
    """Columns that identify and place a record but do not go on the wire."""
    kept = [F.col(name) for name in ("client_id", "seq", "cycle", "compression") if name in df.columns]
    if "config" in df.columns:
        kept.append(F.col("config.compression").alias("compression"))
    return [*kept, F.lit(protocol).alias("protocol")]


def ocpi_records(df: DataFrame) -> DataFrame:
    return df.select(
        *_keys(df, C.OCPI),
        wire_timestamp(F.col("captured_ts")).alias("captured_at"),
        "platform_id",
        "platform_name",
        null_if_empty(F.col("tenant_id")).alias("tenant_id"),
        null_if_empty(F.col("tenant_name")).alias("tenant_name"),
        "direction",
        F.col("method").alias("http_method"),
        "url",
        null_if_zero(F.col("status_code")).cast("int").alias("response_status_code"),
        headers_or_null(F.col("request_headers")).alias("request_headers"),
        body_base64(F.col("request_body")).alias("request_body"),
        headers_or_null(F.col("response_headers")).alias("response_headers"),
        body_base64(F.col("response_body")).alias("response_body"),
    )


def ocpp_records(df: DataFrame) -> DataFrame:
    return df.select(
        *_keys(df, C.OCPP),
        "charger_id",
        "connection_id",
        null_if_empty(F.col("tenant_id")).alias("tenant_id"),
        null_if_empty(F.col("tenant_name")).alias("tenant_name"),
        wire_timestamp(F.col("captured_ts")).alias("captured_at"),
        F.col("event_type").cast("int").alias("event_type"),
        null_if_empty(F.col("direction")).alias("direction"),
        body_base64(F.col("payload")).alias("raw_frame"),
    )


def all_records(ocpi: DataFrame, ocpp: DataFrame) -> DataFrame:
    """Both kinds in one table, told apart by `protocol`; nothing is de-duplicated."""
    return ocpi.unionByName(ocpp, allowMissingColumns=True)
