"""Normalisation of values on their way to the wire record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_empty(text: Column) -> Column:
    """The empty string becomes null; blanks are values and stay."""
    return F.nullif(text, F.lit(""))


def null_if_zero(number: Column) -> Column:
    """Zero becomes null."""
    return F.nullif(number, F.lit(0))


def headers_or_null(headers: Column) -> Column:
    """An empty header map becomes null."""
    return F.when(F.size(headers) > 0, headers)


def body_size(body: Column) -> Column:
    """Size in bytes; a missing body counts as empty."""
    return F.coalesce(F.octet_length(body), F.lit(0))


def body_base64(body: Column) -> Column:
    """Standard base64 on one line; a missing or empty body is null.

    The line breaks that Spark adds under `spark.sql.chunkBase64String.enabled`
    are taken out, so the result is the same under either setting.
    """
    return F.when(
        F.octet_length(body) > 0, F.replace(F.base64(body), F.lit("\r\n"), F.lit(""))
    )


def encode_frame(frame: Column) -> Column:
    """Text frames become their UTF-8 bytes; bytes stay."""
    return frame.cast("binary")


_DAY = 86_400_000


def wire_timestamp(ts: Column) -> Column:
    """RFC 3339, UTC, milliseconds cut off (not rounded), in any session time zone.

    The date is that of whole days since the epoch and the time of day is put
    together from numbers, which no zone's rules touch; any timestamp will do.
    """
    div = lambda a, b: F.call_function("div", a, F.lit(b))
    micros = F.unix_micros(ts.cast("timestamp"))
    millis = div(micros - F.pmod(micros, F.lit(1000)), 1000)
    clock = F.pmod(millis, F.lit(_DAY))
    date = F.date_add(F.lit("1970-01-01").cast("date"), div(millis - clock, _DAY).cast("int"))
    # Hours, minutes, seconds and milliseconds as one number of nine digits.
    minutes, hours = div(clock, 60_000), div(clock, 3_600_000)
    digits = F.lpad((clock + minutes * 40_000 + hours * 4_000_000).cast("string"), 9, "0")
    parts = [F.substring(digits, at, n) for at, n in ((1, 2), (3, 2), (5, 2), (7, 3))]
    marks = map(F.lit, ("T", ":", ":", "."))
    return F.concat(date.cast("string"), *[x for pair in zip(marks, parts, strict=True) for x in pair], F.lit("Z"))


def route(protocol: Column) -> Column:
    """Where batches of this protocol go."""
    return F.concat(F.lit("/v1/"), protocol)


def value_or_default(value: Column, minimum, default) -> Column:
    """The value if it is a number of at least `minimum`, else the default."""
    number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return F.when(number >= F.lit(minimum), value).otherwise(F.lit(default))
