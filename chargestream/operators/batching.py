"""Flush cycles, chunks and batch bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .. import constants as C
from .. import schemas
from ..functions import route
from ..session import stage
from .chunks import bytes_chunks, count_chunks, fits_broadcast, located, starts
from .ordering import with_position
from .records import OCPI_FIELDS, OCPP_FIELDS

# Python-style batch bodies are ASCII; absent values are written as null.
_JSON_OPTIONS = {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"}


def flush_cycle(ts: Column, interval: Column | float = C.DEFAULT_FLUSH_INTERVAL) -> Column:
    """Start of the flush cycle a message belongs to; cycles are aligned to the epoch."""
    seconds = interval if isinstance(interval, Column) else F.lit(float(interval))
    length = F.greatest(F.round(F.least(seconds * 1_000_000, F.lit(9e18))).cast("bigint"), F.lit(1))
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, length))


def with_cycle(df: DataFrame, interval: Column | float = C.DEFAULT_FLUSH_INTERVAL) -> DataFrame:
    return df.withColumn("cycle", flush_cycle(F.col("captured_ts"), interval))


def with_chunk(
    df: DataFrame, keys: Sequence[str] = ("client_id",), size: int = C.BATCH_CAP
) -> DataFrame:
    """Number consecutive slices of at most `size` messages within the keys."""
    placed = with_position(df, keys, "__position")
    chunk = F.expr(f"__position div {int(size)}")
    return placed.withColumn("chunk", chunk).drop("__position")


def chunk_summary(df: DataFrame, keys: Sequence[str] = ("client_id",)) -> DataFrame:
    """Per chunk: how many messages it has, and the first and last of them."""
    return df.groupBy(*keys, "chunk").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )


# What a body has beside its records and a comma for each.
_BODY_BYTES = 14


def _record(fields: Sequence[str]) -> Column:
    # U+007F is the one character the JSON writer leaves as it is.
    return F.replace(F.to_json(F.struct(*fields), _JSON_OPTIONS), F.lit("\x7f"), F.lit("\\u007f"))


def _grouped(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("seq", F.col("__record").alias("record"))))
    return rows.groupBy(*by).agg(ordered.alias("__records"))


def _bodies(grouped: DataFrame, keys: Sequence[str], codec: Column) -> DataFrame:
    records = F.transform("__records", lambda item: item["record"])
    return (
        grouped.select(
            "protocol",
            *keys,
            "chunk",
            codec.alias("__codec"),
            F.size("__records").alias("n_messages"),
            F.col("__records")[0]["seq"].alias("first_seq"),
            F.element_at("__records", -1)["seq"].alias("last_seq"),
            F.concat(F.lit('{"messages":['), F.array_join(records, ","), F.lit("]}")).alias("body"),
        )
        .withColumn("route", route(F.col("protocol")))
        .withColumn("body_bytes", F.octet_length("body"))
        .withColumn("content_encoding", content_encoding(F.col("body_bytes"), F.col("__codec")))
        .drop("__codec")
    )


def _with_record(df: DataFrame, fields: Sequence[str], compression: Column | str, *names: str) -> DataFrame:
    """Keys, `seq`, codec and the finished JSON of every record; nothing else is shuffled."""
    codec = compression if isinstance(compression, Column) else F.lit(compression)
    return df.select("protocol", *names, "seq", codec.alias("__codec"), _record(fields).alias("__record"))


def assemble_envelopes(
    df: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = ("client_id",),
    compression: Column | str = C.DEFAULT_COMPRESSION,
) -> DataFrame:
    """One batch body per `chunk` that is already there, its records in order.

    A group has at most one chunk of records. Records become JSON before the
    shuffle, so the shuffle carries the finished text and nothing else.
    """
    rows = _with_record(df, fields, compression, *keys, "chunk")
    return _bodies(_grouped(rows, ["protocol", *keys, "chunk", "__codec"]), keys, F.col("__codec"))


def batch_bodies(
    df: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = ("client_id",),
    size: int = C.BATCH_CAP,
    max_bytes: int | None = None,
    compression: Column | str = C.DEFAULT_COMPRESSION,
) -> DataFrame:
    """Cut records into ordered batches of at most `size`, and of `max_bytes` of body if given, each written as one body.

    A record that is larger than that by itself is a batch of its own. The cuts
    are found on narrow rows. Whole records are shuffled once: a batch whose
    records all are in one range of `seq` is put together where the range is,
    and only batches that cross a border are shuffled again.
    """
    keys = list(keys)
    rows = _with_record(df, fields, compression, *keys)
    if max_bytes is None:
        chunked = count_chunks(df.select(*keys, "seq"), keys, size)
    else:
        rows = stage(rows.withColumn("__bytes", F.octet_length("__record").cast("bigint") + 1), "batch-records")
        chunked = bytes_chunks(rows.select(*keys, "seq", "__bytes"), keys, size, max_bytes - _BODY_BYTES)
    side = stage(starts(chunked, keys), "batch-starts")
    placed = located(rows, side, keys)
    by = ["protocol", *keys, "chunk", "__codec"]
    if fits_broadcast(side):
        grouped = _grouped(placed, by)
    else:
        inside = _grouped(placed.where("__whole"), [*by, "__range"]).drop("__range")
        grouped = inside.unionByName(_grouped(placed.where("not __whole"), by))
    return _bodies(grouped, keys, F.col("__codec"))


def content_encoding(body_bytes: Column, codec: Column) -> Column:
    """Small bodies are sent as they are; the others with the chosen codec."""
    return F.when(body_bytes < C.COMPRESS_MIN_BYTES, F.lit("identity")).otherwise(codec)


def ocpi_envelopes(df: DataFrame, keys: Sequence[str] = ("client_id",), **options) -> DataFrame:
    return assemble_envelopes(df, OCPI_FIELDS, keys, **options)


def ocpp_envelopes(df: DataFrame, keys: Sequence[str] = ("client_id",), **options) -> DataFrame:
    return assemble_envelopes(df, OCPP_FIELDS, keys, **options)


def _decode(df: DataFrame, record: StructType) -> DataFrame:
    others = [name for name in df.columns if name != "body"]
    # In brackets, because the parser overlooks text after the end of a document.
    wrapped = F.concat(F.lit("["), F.col("body"), F.lit("]"))
    parsed = F.from_json(wrapped, ArrayType(schemas.envelope(record)))
    messages = F.when(F.size(parsed) == 1, parsed[0]["messages"])
    return df.select(*others, F.explode(messages).alias("__message")).select(*others, "__message.*")


def _decoded(df: DataFrame, record: StructType, bodies: Sequence[str]) -> tuple[DataFrame, Column]:
    """Records with their bodies as bytes under `__name`, and whether all that was given did decode."""
    records = _decode(df, record)
    raw = {f"__{name}": F.try_to_binary(F.col(name), F.lit("base64")) for name in bodies}
    sound = F.lit(True)
    for name in bodies:
        sound = sound & (F.col(name).isNull() | F.col(f"__{name}").isNotNull())
    return records.withColumns(raw), sound


def _sound(df: DataFrame, record: StructType, bodies: Sequence[str]) -> DataFrame:
    rows, sound = _decoded(df, record, bodies)
    return rows.where(sound).withColumns({name: F.col(f"__{name}") for name in bodies}).drop(*[f"__{name}" for name in bodies])


_OCPI_BODIES = ("request_body", "response_body")
_OCPP_BODIES = ("raw_frame",)


def decode_ocpi(df: DataFrame) -> DataFrame:
    """Records of OCPI batch bodies, their bodies as raw bytes. Malformed bodies yield none."""
    return _sound(df, schemas.OCPI_RECORD, _OCPI_BODIES)


def decode_ocpp(df: DataFrame) -> DataFrame:
    """Records of OCPP batch bodies, their frames as text. Malformed bodies yield none."""
    return _sound(df, schemas.OCPP_RECORD, _OCPP_BODIES).withColumn("raw_frame", F.col("raw_frame").cast("string"))


def decode_faults(df: DataFrame, protocol: str) -> DataFrame:
    """The records that `decode_*` leaves out, as they were sent, because a body is not base64."""
    ocpi = protocol == C.OCPI
    bodies = _OCPI_BODIES if ocpi else _OCPP_BODIES
    rows, sound = _decoded(df, schemas.OCPI_RECORD if ocpi else schemas.OCPP_RECORD, bodies)
    return rows.where(~sound).drop(*[f"__{name}" for name in bodies]).withColumn("drop_reason", F.lit(C.UNDECODABLE_BODY))
